"""Payloads as files: each is redacted, written beside the old one and swapped in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.times import at, iso
from newsloom.functions.titles import redact_all
from newsloom.operators import items as repeats
from newsloom.operators import stats, stories
from newsloom.runtime import exists, move, remove


def swap_in(df: DataFrame, path: str, kind: str = "json") -> None:
    """Writes ``df`` as a folder; the old one stays until the new one is complete, so it may be read by ``df``.

    Between the two moves the old payload lies under ``path.old``; ``payload`` finds it there, and the
    next swap puts it back, so that a stop at any point loses neither.
    """
    spark = df.sparkSession
    _recover(spark, path)
    redact_all(df).write.mode("overwrite").format(kind).save(f"{path}.new")
    if exists(spark, path):
        move(spark, path, f"{path}.old")
    move(spark, f"{path}.new", path)
    remove(spark, f"{path}.old")


def _recover(spark: SparkSession, path: str) -> None:
    if exists(spark, f"{path}.old"):
        if exists(spark, path):
            remove(spark, f"{path}.old")
        else:
            move(spark, f"{path}.old", path)


def payload(spark: SparkSession, path: str, kind: str = "json", schema: str | None = None) -> DataFrame:
    """What was last swapped in."""
    _recover(spark, path)
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema else reader).load(path)


def as_text(df: DataFrame) -> DataFrame:
    """Times as ISO text in UTC."""
    return df.select(*[iso(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName().startswith("timestamp") else F.col(f"`{f.name}`") for f in df.schema.fields])


def latest(items: DataFrame, now: dt.datetime, hours: int) -> DataFrame:
    """One row: counts and statistics of the window; the items themselves stay a table beside it."""
    by_site = stats.site_stats(items, items).agg(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("order"), "site_id", "site_name", "count", "raw_count"))).alias("site_stats"))
    # One row a site; sites are few.
    total = items.agg(F.count("*").alias("total_items"), F.count_distinct("site_id", F.coalesce("source", F.lit(""))).alias("source_count"))
    head = items.sparkSession.range(1).select(iso(at(now)).alias("generated_at"), F.lit(hours).alias("window_hours"), F.lit(None).cast("string").alias("topic_filter"))
    return head.crossJoin(total).crossJoin(by_site.select(F.transform("site_stats", lambda s: s.dropFields("order")).alias("site_stats")))


def write_all(path: str, shown: DataFrame, raw: DataFrame, story_table: DataFrame, events: DataFrame, archive: DataFrame, statuses: DataFrame, cache: DataFrame, week: DataFrame, now: dt.datetime, hours: int = 24) -> list[str]:
    """All payloads under ``path``: the window slim and whole, brief, stories, merge log, archive, status, cache, digest."""
    once = repeats.latest_first(shown)
    picked = stories.brief(story_table)
    tables: dict[str, DataFrame] = {
        "latest-summary": latest(shown, now, hours),
        "latest-items": as_text(once),
        "latest-items-raw": as_text(repeats.latest_first(raw)),
        "daily-brief": as_text(story_table.join(picked, "story_id").orderBy("rank")),
        "stories-merged": as_text(stories.in_order(story_table)),
        "merge-log": events,
        "archive": as_text(archive.orderBy(F.col("last_seen_at").desc_nulls_last(), "ordinal")),
        "source-status": statuses,
        "title-cache": cache,
        "week-digest": week,
    }
    for name, df in tables.items():
        swap_in(df, f"{path}/{name}")
    return list(tables)


def slim(items: DataFrame, *columns: str) -> DataFrame:
    return items.select(*(columns or ("id", "site_id", "source", "title", "url", "published_at")))


def as_json(df: DataFrame) -> Column:
    """Each row as one JSON text."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
