"""Runs of equal or nearly equal consecutive caption lines (problem 3).

Every line event of a file becomes one symbol: its canonical form is mapped to a Unicode code
point, and a line that is like the one before takes that one's symbol. The symbols of a file are
one string; a backreference finds the repetitions, and their spans are mapped back to cues.

Defined results: files that are null, empty or without cues give no rows, and so do lines without
letter or digit; two rows with the same vtt_id are two files. A file is one row, so no group of
rows ever meets in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from newsloom.sources.vtt import by_start, cues, plain

#: Words that the longer of two lines must have for one differing word to be let pass.
NEAR_WORDS = 6
_NOT_ALNUM = re.compile(r"[\W_]+")
_RUN = re.compile(r"(.)\1*", re.S)
#: Code points for symbols: the private planes, used in turn.
_FIRST, _MANY = 0xF0000, 0x1FFFE


def canonical(line: str) -> str:
    return _NOT_ALNUM.sub("", line.upper().casefold())


def words(line: str) -> list[str]:
    """Canonical words; marks that stand alone are none."""
    return [k for w in line.split() if (k := canonical(w))]


def one_word_apart(a: list[str], b: list[str]) -> bool:
    """One word added, dropped or changed turns ``a`` into ``b`` (or they are equal)."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


def alike(a: str, b: str, key_a: str, key_b: str) -> bool:
    if key_a == key_b:
        return True
    if len(a.split()) < NEAR_WORDS and len(b.split()) < NEAR_WORDS:
        return False
    x, y = words(a), words(b)
    return max(len(x), len(y)) >= NEAR_WORDS and one_word_apart(x, y)


def events(vtt: str | None) -> list[tuple[int, int, int, str, str]]:
    """(cue_no, start_ms, end_ms, line, canonical form), in order of start time."""
    found = []
    for c in by_start(cues(vtt)):
        for line in c.lines:
            text = plain(line)
            if key := canonical(text):
                found.append((c.cue_no, c.start_ms, c.end_ms, text.strip(), key))
    return found


def symbols(found: list[tuple[int, int, int, str, str]]) -> str:
    """A code point for each event; neighbours share it exactly if they are alike."""
    out: list[str] = []
    known: dict[str, int] = {}
    before = None
    for e in found:
        if before is not None and alike(before[3], e[3], before[4], e[4]):
            out.append(out[-1])
        else:
            s = chr(_FIRST + known.setdefault(e[4], len(known)) % _MANY)
            if out and s == out[-1]:  # the code points came round again, or a near form has this one
                s = chr(_FIRST + (ord(s) - _FIRST + 1) % _MANY)
            out.append(s)
        before = e
    return "".join(out)


def runs(vtt: str | None) -> list[tuple[int, int, int, str, int, int]]:
    """(first_cue_no, last_cue_no, n_lines, line, start_ms, end_ms) of every run, single lines too."""
    found = events(vtt)
    rows = []
    for m in _RUN.finditer(symbols(found)):
        part = found[m.start() : m.end()]
        rows.append((part[0][0], part[-1][0], len(part), part[0][3], part[0][1], part[-1][2]))
    return rows


_RUNS = "vtt_id long, first_cue_no int, last_cue_no int, n_lines int, line string, start_ms long, duration_ms long"


def collapsed(files: DataFrame) -> DataFrame:
    """Each run of a file once, with its count of lines and the time from first start to last end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, a, z, n, line, s, e - s) for i, vtt in zip(b["vtt_id"], b["vtt"], strict=True) for a, z, n, line, s, e in runs(vtt)]
            yield pd.DataFrame(rows, columns=["vtt_id", "first_cue_no", "last_cue_no", "n_lines", "line", "start_ms", "duration_ms"])

    return files.select("vtt_id", "vtt").mapInPandas(run, _RUNS)


def repeated(files: DataFrame) -> DataFrame:
    """vtt_id, first_cue_no, last_cue_no, n_lines of the runs of two or more lines."""
    return collapsed(files).where("n_lines >= 2").select("vtt_id", "first_cue_no", "last_cue_no", "n_lines")
