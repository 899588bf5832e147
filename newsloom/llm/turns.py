"""Speech transcripts as clean, ordered speaker turns (problem 5).

A file is cut into segments where its clock starts anew; in each, the cues are put in order of
start time, and stamps that contradict each other (an end before its start) are repaired with the
starts around them by isotonic regression (pool adjacent violators); segments follow each other on
one clock. Cues that overlap are cross-talk and keep their bounds. Bounds of turns come from the
repaired stamps; which cue a turn begins with and who speaks doesn't depend on them.
A small grammar takes labels, marks, sounds and hesitations out of the lines; what is left are
words, and neighbouring words of one roster speaker are one turn.

Defined results: files without roster rows, null files and files without cues give no turns; a
label that fits no roster name is speech; a label that fits several names is a mark that names
nobody; of a language without a list of hesitations only those that all share are left out. Each file is one row with its roster beside it, so no group grows with the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.sources.vtt import Cue, by_start, cues, plain

UNKNOWN = "unknown"
#: A start this much before the one in the line before it, and near zero, is a new clock.
RESET_MS = 60_000

# Hesitation sounds by language, as patterns over the bare word.
HESITATIONS = {
    "en": r"u+h+|u+m+|e+r+m*|h*m{2,}|hm+|mhm|ah+|eh+|oh+m",
    "de": r"ä+h+m*|h+m+|öh+m*|mhm|ehm?",
    "fr": r"e+u+h+|h+u+m+|h+m+|heu+|mm+",
    "es": r"e+h+|e+m+|m{2,}|h+m+|ehm",
    "zh": r"呃+|嗯+|唔+",
}
_ANY = "|".join([r"u+h+|h+m+|ä+h+m*|e+u+h+|呃+|嗯+"])
_HESITATION = {k: re.compile(rf"(?:{v}|{_ANY})") for k, v in HESITATIONS.items()}
#: Of a language without a list, only the sounds that all share are taken for hesitations.
_OTHER = re.compile(_ANY)
_SOUND = re.compile(r"\[[^\[\]]*\]|\([^()]*\)|\*[^*]*\*|[♪♫][^♪♫]*[♪♫]?")
_VOICE = re.compile(r"<v(?:\.[^\s>]*)?\s+([^>]+)>")
_LABEL = re.compile(r"^\s*(?P<mark>>>+|»)?\s*(?:[-–—]\s+)?(?:\[(?P<square>[^\[\]]{1,60})\]|\((?P<round>[^()]{1,60})\)|(?P<name>[^:：\[\]<>]{1,70}?)(?=\s*[:：]))\s*[:：]?\s*")
_MARK = re.compile(r"^\s*(?:>>+|»)\s*")
_WORD = re.compile(r"[^\W_]")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def _name(text: str) -> str:
    """A name as it is compared: roles in brackets, dots, commas and case aside."""
    return " ".join(re.sub(r"[.,]", " ", text.casefold()).split())


class Roster:
    """Who a label can mean in one file."""

    def __init__(self, speakers: list[tuple[str, str]]):
        self.forms: dict[str, set[str]] = {}
        self.parts: dict[str, set[str]] = {}
        self.roles = {r.casefold() for _, r in speakers if r}
        for full, role in speakers:
            words = _name(full).split()
            if not words:
                continue
            first, last = words[0], words[-1]
            forms = {" ".join(words), first, last, f"{last} {' '.join(words[:-1])}", f"{first[0]} {last}", "".join(w[0] for w in words)}
            if role:
                forms.add(_name(role))
            for f in forms:
                self.forms.setdefault(f.strip(), set()).add(full)
            for f in (first, last, " ".join(words)):
                self.parts.setdefault(f, set()).add(full)

    def find(self, label: str) -> set[str]:
        """The speakers that a label can mean; none if it is no label."""
        text = _name(label)
        bare = re.sub(r"\s*\([^()]*\)\s*$", "", text).strip()
        words = bare.split()
        tries = [bare]
        if len(words) > 1 and words[0] in self.roles:
            tries.append(" ".join(words[1:]))
        if len(words) > 1 and words[-1] in self.roles:
            tries.append(" ".join(words[:-1]))
        for t in tries:
            if t in self.forms:
                return self.forms[t]
        for t in tries:
            if len(t) >= 4 and len(t.split()) <= 3:
                near = [who for part, who in self.parts.items() if len(part) >= 4 and _close(t, part)]
                if near:
                    return set().union(*near)
        return set()


def _close(a: str, b: str) -> bool:
    """One letter added, dropped, changed or two neighbours exchanged."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (x[:2] == y[1::-1] and x[2:] == y[2:] and len(x) > 1)


def isotonic(values: list[float]) -> list[float]:
    """The non-decreasing sequence nearest to ``values`` in squares: pool adjacent violators."""
    pools: list[list[float]] = []
    for v in values:
        pools.append([v, 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            v2, n2 = pools.pop()
            v1, n1 = pools.pop()
            pools.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2])
    return [v for v, n in pools for _ in range(int(n))]


def repaired(found: list[Cue]) -> list[Cue]:
    """Cues in order, one clock, bounds that never run backwards."""
    segments: list[list[Cue]] = []
    high = 0
    for c in found:
        if not segments or (c.start_ms < high - RESET_MS and c.start_ms < RESET_MS):
            segments.append([])
            high = 0
        segments[-1].append(c)
        high = max(high, c.start_ms)
    out: list[Cue] = []
    shift = 0
    for part in segments:
        part = by_start(part)
        # Each start, and each end that contradicts its start, in order.
        fitted = iter(isotonic([x for c in part for x in ((c.start_ms, c.end_ms) if c.end_ms < c.start_ms else (c.start_ms,))]))
        high = shift
        for c in part:
            a = int(next(fitted))
            z = int(next(fitted)) if c.end_ms < c.start_ms else max(a, c.end_ms)
            out.append(c._replace(start_ms=a + shift, end_ms=z + shift))
            high = max(high, z + shift)
        shift = high
    return out


class Turn(NamedTuple):
    turn_no: int
    speaker: str
    first_cue_no: int
    start_ms: int
    end_ms: int
    text: str


def _labelled(line: str, roster: Roster) -> list[tuple[str | None, str]]:
    """(who speaks from here, or None if that goes on; text) of one line."""
    out: list[tuple[str | None, str]] = []
    at = 0
    who = None
    pieces: list[tuple[str | None, str]] = []
    for m in _VOICE.finditer(line):
        pieces.append((who, line[at : m.start()]))
        found = roster.find(plain(m[1]))
        who, at = (next(iter(found)) if len(found) == 1 else UNKNOWN), m.end()
    pieces.append((who, line[at:]))
    for who, piece in pieces:
        text = plain(piece)
        m = _LABEL.match(text)
        label = m and next((g for g in (m["square"], m["round"], m["name"]) if g), None)
        found = roster.find(label) if label else set()
        if found:
            who, text = (next(iter(found)) if len(found) == 1 else UNKNOWN), text[m.end() :]
        elif mark := _MARK.match(text):
            who, text = UNKNOWN, text[mark.end() :]
        out.append((who, text))
    return out


def turns(vtt: str | None, lang: str | None, speakers: list[tuple[str, str]]) -> list[Turn]:
    """The turns of one file; ``speakers``: (name, role) of its roster."""
    roster = Roster(speakers)
    hesitation = _HESITATION.get((lang or "en").split("-")[0].lower(), _OTHER)
    out: list[list] = []
    who = UNKNOWN
    for c in repaired(cues(vtt)):
        spans: list[list] = []
        for line in c.lines:
            for said_by, text in _labelled(line, roster):
                if said_by is not None:
                    who = said_by
                if spans and spans[-1][0] == who:
                    spans[-1][1] += " " + text
                else:
                    spans.append([who, text])
        for speaker, text in spans:
            words = [w for w in _SOUND.sub(" ", text).split() if _WORD.search(w) and not hesitation.fullmatch(_EDGE.sub("", w).casefold())]
            if not words:
                continue
            if out and out[-1][0] == speaker:
                out[-1][3], out[-1][4] = max(out[-1][3], c.end_ms), out[-1][4] + words
            else:
                out.append([speaker, c.cue_no, c.start_ms, c.end_ms, words])
    return [Turn(n, s, first, a, z, " ".join(words)) for n, (s, first, a, z, words) in enumerate(out, 1)]


_TURNS = "vtt_id long, turn_no int, speaker string, first_cue_no int, start_ms long, end_ms long, text string"


def speaker_turns(files: DataFrame, roster: DataFrame) -> DataFrame:
    """The turns of every file that has roster rows."""
    people = (
        roster.where(F.col("speaker_name").isNotNull())
        .groupBy("vtt_id")
        .agg(F.array_sort(F.collect_set(F.struct("speaker_no", "speaker_name", F.coalesce("speaker_role", F.lit("")).alias("speaker_role")))).alias("people"))
    )
    joined = files.select("vtt_id", "lang", "vtt").join(people, "vtt_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (r.vtt_id, t.turn_no, t.speaker, t.first_cue_no, t.start_ms, t.end_ms, t.text)
                for r in b.itertuples(index=False)
                for t in turns(r.vtt, r.lang, [(p["speaker_name"], p["speaker_role"]) for p in np.atleast_1d(r.people)])
            ]
            yield pd.DataFrame(rows, columns=["vtt_id", "turn_no", "speaker", "first_cue_no", "start_ms", "end_ms", "text"])

    return joined.mapInPandas(run, _TURNS)
