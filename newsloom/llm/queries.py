"""Queries of the operators for training text, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import garbled, history, leaks, packing, repeats, splitting, turns
from newsloom.runtime import scratch, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.replay(table(spark, sf_dir, "archive_item")).repeats()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated(table(spark, sf_dir, "subtitles"))


def p3_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.collapsed(table(spark, sf_dir, "subtitles"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.restored(table(spark, sf_dir, "raw_item"))


def p5_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.speaker_turns(table(spark, sf_dir, "subtitles"), table(spark, sf_dir, "speaker_roster"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_turns(spark, sf_dir).select("vtt_id", "first_cue_no", "speaker")


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.cleaned(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.pieces(table(spark, sf_dir, "documents"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of a packing: every text is in it once, and no sequence is above the capacity."""
    placed = packing.assignments(packing.packed(table(spark, sf_dir, "documents")))
    return placed.groupBy("doc_id").agg(F.count_if(F.col("first_token") == 0).alias("n_copies"), F.count_if(F.col("n_tokens") > packing.CAPACITY).alias("n_over"))


def p10_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of pieces: without overlaps they are the text letter by letter, and none is above the limit."""
    own = F.expr("substring(text, overlap_chars + 1)")
    p = splitting.pieces(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", F.struct("piece_no", "first_char", own.alias("t")).alias("p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["t"]), "")  # no more than the text itself
    return p.groupBy("doc_id").agg(F.md5(joined).alias("text"), F.count_if(F.col("n_tokens") > splitting.LIMIT).alias("n_over"))


def p10_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written to a few files, and these cut by ranges of bytes, none loaded as a whole."""
    path = scratch(spark, "texts")
    table(spark, sf_dir, "documents").where(F.length("text") > 0).select("text").write.text(path)
    return splitting.file_pieces(spark, f"{path}/part-*").select("path", "piece_no", "first_byte", "end_byte", "overlap_bytes", "n_tokens", "cut_at")


ORACLE = {
    "p8_items": "SELECT doc_id, 1::BIGINT AS n_copies, 0::BIGINT AS n_over FROM documents WHERE length(text) > 0",
    "p10_joined": "SELECT doc_id, md5(text) AS text, 0::BIGINT AS n_over FROM documents WHERE length(text) > 0",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, f in globals().items() if n.startswith("p") and n[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
