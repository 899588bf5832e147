"""WebVTT caption files."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLOCK = r"(?:(\d+):)?(\d{1,2}):(\d{2})[.,](\d{1,3})"
_TIMING = re.compile(rf"^\s*{_CLOCK}\s*-->\s*{_CLOCK}(.*)$", re.S)
_BREAK = re.compile(r"\r\n|\n|\r")
_TAG = re.compile(r"<[^<>]*>")


class Cue(NamedTuple):
    cue_no: int
    start_ms: int
    end_ms: int
    settings: str
    lines: list[str]


def _ms(hours: str | None, minutes: str, seconds: str, fraction: str) -> int:
    return int(hours or 0) * 3_600_000 + int(minutes) * 60_000 + int(seconds) * 1000 + int(fraction.ljust(3, "0"))


def cues(vtt: str | None) -> list[Cue]:
    """The cues of a file, in file order; a cue ends at the next empty line or timing line.

    Headers, notes, styles and cue ids are passed over; null, empty and cue-less files give none.
    """
    found: list[Cue] = []
    lines: list[str] | None = None
    for line in _BREAK.split(vtt or ""):
        if "-->" in line and (m := _TIMING.match(line)):
            g = m.groups()
            lines = []
            found.append(Cue(len(found) + 1, _ms(*g[:4]), _ms(*g[4:8]), g[8].strip(), lines))
        elif not line:
            lines = None
        elif lines is not None:
            lines.append(line)
    return found


def by_start(found: list[Cue]) -> list[Cue]:
    """Cues in order of start time; equal starts keep the order of the file."""
    return sorted(found, key=lambda c: c.start_ms)


def plain(line: str) -> str:
    """A line without tags, entities decoded."""
    return html.unescape(_TAG.sub("", line)).replace("\xa0", " ") if "<" in line or "&" in line else line.replace("\xa0", " ")


_CUES = "vtt_id long, item_id string, lang string, cue_no int, start_ms long, end_ms long, settings string, text string"


def explode_cues(files: DataFrame) -> DataFrame:
    """One row for each cue of ``files`` (vtt_id, item_id, lang, vtt); text is the lines without tags."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [
                (r.vtt_id, r.item_id, r.lang, c.cue_no, c.start_ms, c.end_ms, c.settings, "\n".join(plain(x) for x in c.lines))
                for r in b.itertuples(index=False)
                for c in cues(r.vtt)
            ]
            yield pd.DataFrame(rows, columns=["vtt_id", "item_id", "lang", "cue_no", "start_ms", "end_ms", "settings", "text"])

    return files.select("vtt_id", "item_id", "lang", "vtt").mapInPandas(run, _CUES)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """item_id, lang, file_name, vtt of the files ``{item_id}.NA.{lang}.vtt`` under ``path``."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    raw = spark.read.text(path, wholetext=True, pathGlobFilter="*.vtt").select(F.col("value").alias("vtt"), name.alias("file_name"))
    return raw.select(
        F.regexp_extract("file_name", r"^([^.]+)\.", 1).alias("item_id"), F.regexp_extract("file_name", r"^[^.]+\.[^.]+\.(.+)\.vtt$", 1).alias("lang"), "file_name", "vtt"
    )
