"""Caption corpora: cues, rolling captions, transcripts, coverage, speech rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import squeeze


def derolled(cues: DataFrame) -> DataFrame:
    """Cues without what a rolling caption repeats: a first line equal to the last line of the cue before.

    Only cues marked as automatic (they start at position 0%) are touched, so that a line that is
    really said twice stays; a cue left without text is dropped.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    c = cues.withColumn("lines", lines)
    before = F.element_at(F.lag("lines").over(Window.partitionBy("vtt_id").orderBy("start_ms", "cue_no")), -1)
    rolled = F.col("settings").contains("position:0%") & (F.try_element_at(F.col("lines"), F.lit(1)) == before)
    c = c.withColumn("lines", F.when(F.coalesce(rolled & (F.size("lines") > 0), F.lit(False)), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(1)))).otherwise(F.col("lines")))
    return c.withColumn("text", F.array_join("lines", "\n")).drop("lines").where("text <> ''")


def transcripts(cues: DataFrame) -> DataFrame:
    """vtt_id, item_id, lang, n_cues, text: the cues of a file in order."""
    ordered = F.array_sort(F.collect_list(F.struct("start_ms", "cue_no", "text")))
    return cues.groupBy("vtt_id", "item_id", "lang").agg(F.count("*").alias("n_cues"), squeeze(F.array_join(F.transform(ordered, lambda c: c["text"]), " ")).alias("text"))


def coverage(files: DataFrame) -> DataFrame:
    """item_id, langs, n_files: the languages an item has captions in."""
    return files.groupBy("item_id").agg(F.array_sort(F.collect_set("lang")).alias("langs"), F.count("*").alias("n_files"))


def speech_rate(cues: DataFrame) -> DataFrame:
    """vtt_id, minute, n_words, n_cues by the minute in which a cue starts."""
    words = F.size(F.filter(F.split(squeeze(F.col("text")), " "), lambda w: w != ""))
    return cues.groupBy("vtt_id", F.floor(F.col("start_ms") / 60_000).alias("minute")).agg(F.sum(words).alias("n_words"), F.count("*").alias("n_cues"))


def overlaps(cues: DataFrame) -> DataFrame:
    """vtt_id, n_overlaps: cues that start before the one before them ends."""
    w = Window.partitionBy("vtt_id").orderBy("cue_no")
    return cues.select("vtt_id", (F.col("start_ms") < F.lag("end_ms").over(w)).alias("over")).groupBy("vtt_id").agg(F.count_if("over").alias("n_overlaps"))


def pending(archive: DataFrame, captioned: DataFrame, limit: int | None = 70) -> DataFrame:
    """Videos without captions and without a summary, in the archive's order."""
    videos = archive.where(F.col("id").isNotNull() & (F.col("url").contains("youtube.com") | F.col("url").contains("youtu.be") | F.col("url").contains("vids.example")) & F.col("summary").isNull())
    out = videos.join(captioned.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti").orderBy("ordinal")
    return out.limit(limit) if limit is not None else out
