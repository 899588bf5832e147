"""The trailing window of the archive as display items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import is_blank, strip
from newsloom.functions.times import at, event_time
from newsloom.functions.titles import has_han, mostly_english
from newsloom.functions.udf import undo_mojibake
from newsloom.functions.urls import host_of, normalize_url
from newsloom.plans.dims import tier
from newsloom.runtime import small_side

WINDOW_HOURS = 24


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_at", event_time(F.col("site_id"), F.col("published_at"), F.col("first_seen_at")))


def window(archive: DataFrame, now: dt.datetime, hours: int = WINDOW_HOURS) -> DataFrame:
    """Rows whose event time is known and not older than the window; the future is not cut off."""
    return with_event_time(archive).where(F.col("event_at") >= at(now - dt.timedelta(hours=hours)))


def display_source(site_id: Column, source: Column, url: Column) -> Column:
    """The source; its host where it is blank or only names an aggregator."""
    host = F.regexp_replace(host_of(F.coalesce(url, F.lit(""))), r"^www\.", "")
    named = F.when(host == "", "未分区").otherwise(host)
    s = strip(F.coalesce(source, F.lit("")))
    return F.when(s == "", named).when((site_id == "buzzing") & (F.lower(s) == "buzzing"), named).otherwise(s)


def placeholder(title: Column) -> Column:
    t = strip(F.lower(F.coalesce(title, F.lit(""))))
    return (t == "") | t.isin("阅读全文", "查看详情", "more", "read more")


def displayed(items: DataFrame) -> DataFrame:
    """Display items: garbling of one step undone, source named, tier fields, no placeholder titles of daily pages."""
    d = items.withColumns({"title_original": F.col("title"), "title": undo_mojibake("title"), "source": undo_mojibake(display_source(F.col("site_id"), F.col("source"), F.col("url")))})
    d = d.where(~((F.col("site_id") == "aihubtoday") & placeholder(F.col("title"))))
    return with_tier(d)


def with_tier(df: DataFrame) -> DataFrame:
    """Adds source_tier, source_tier_label and source_tier_rank."""
    t = df.withColumn("_tier", tier(F.col("site_id")))
    return t.select(*df.columns, "_tier.source_tier", "_tier.source_tier_label", "_tier.source_tier_rank")


def bilingual(items: DataFrame, cache: DataFrame, translate: Column | None = None) -> DataFrame:
    """title_en, title_zh, title_bilingual: a Chinese title of the same page, else the cache, else ``translate``.

    Pages are looked up by normalized url among the items, the last Chinese title counts. A
    translation counts only if it holds Han; without one, the title stays alone.
    """
    d = items.withColumn("_page", normalize_url(F.col("url")))
    by_page = d.where(has_han(F.col("title"))).groupBy("_page").agg(F.max_by("title", "ordinal").alias("_page_zh"))
    known = cache.where(~is_blank(F.col("title")) & ~is_blank(F.col("title_zh"))).groupBy("title").agg(F.max("title_zh").alias("_cache_zh"))
    d = d.join(by_page, "_page", "left").join(small_side(known), "title", "left")
    zh = F.coalesce("_page_zh", "_cache_zh", *([translate] if translate is not None else []))
    english = mostly_english(F.col("title"))
    zh = F.when(has_han(F.col("title")), F.col("title")).when(english & has_han(zh), zh)
    d = d.withColumns({"title_en": F.when(english, F.col("title")), "title_zh": zh})
    both = F.when(F.col("title_en").isNotNull() & F.col("title_zh").isNotNull(), F.concat("title_zh", F.lit(" / "), "title_en")).otherwise(F.col("title"))
    return d.withColumn("title_bilingual", both).drop("_page", "_page_zh", "_cache_zh")


def dedup_key(site_id: Column, title: Column, url: Column) -> Column:
    """Title and page; for daily pages the page alone."""
    page = normalize_url(F.coalesce(url, F.lit("")))
    return F.when(site_id == "aihubtoday", F.concat(F.lit("url||"), page)).otherwise(F.concat(F.lower(strip(F.coalesce(title, F.lit("")))), F.lit("||"), page))
