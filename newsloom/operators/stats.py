"""Counts by site and source, feed and site status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def site_stats(raw: DataFrame, items: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """site_id, site_name, raw_count, count; sites without items have zero counts."""
    a = raw.groupBy("site_id").agg(F.count("*").alias("raw_count"), F.max_by("site_name", "ordinal").alias("raw_name"))
    b = items.groupBy("site_id").agg(F.count("*").alias("count"), F.min_by("site_name", "ordinal").alias("name"))
    j = a.join(b, "site_id", "full_outer")
    if sites is not None:
        j = j.join(sites.select("site_id", F.col("site_name").alias("listed")).dropDuplicates(["site_id"]), "site_id", "full_outer")
    name = [F.col("name"), F.col("raw_name"), *([F.col("listed")] if sites is not None else []), F.col("site_id")]
    return j.select("site_id", F.coalesce(*name).alias("site_name"), F.coalesce("raw_count", F.lit(0)).alias("raw_count"), F.coalesce("count", F.lit(0)).alias("count"))


def source_count(items: DataFrame) -> DataFrame:
    """n_sources: distinct pairs of site and source."""
    return items.agg(F.count_distinct("site_id", F.coalesce("source", F.lit(""))).alias("n_sources"))


def totals(items: DataFrame, stories: DataFrame) -> DataFrame:
    return items.agg(F.count("*").alias("total_items")).crossJoin(stories.agg(F.count("*").alias("total_stories")))


def rollup(statuses: DataFrame) -> DataFrame:
    """n_ok, n_failed, n_skipped, n_replaced, n_items, duration_ms over (ok, skipped, replaced, n_items, duration_ms)."""
    skipped, replaced = F.coalesce("skipped", F.lit(False)), F.coalesce("replaced", F.lit(False))
    return statuses.agg(
        F.count_if("ok").alias("n_ok"),
        F.count_if(~F.coalesce("ok", F.lit(False))).alias("n_failed"),
        F.count_if(skipped).alias("n_skipped"),
        F.count_if(replaced).alias("n_replaced"),
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_items"),
        F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("duration_ms"),
    )


def failed_and_empty(statuses: DataFrame) -> DataFrame:
    """failed, empty: sorted names of the sites that failed and of those that gave nothing. Sites are few."""
    ok = F.coalesce("ok", F.lit(False))
    return statuses.agg(F.array_sort(F.collect_set(F.when(~ok, F.col("site_id")))).alias("failed"), F.array_sort(F.collect_set(F.when(ok & (F.coalesce("n_items", F.lit(0)) == 0), F.col("site_id")))).alias("empty"))
