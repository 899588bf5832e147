"""Sources put together from several documents: subscriptions, official feeds, feeds of feeds, fallbacks.

``fetch`` is the caller's function from url to text; it runs in the tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import feeds as rules
from newsloom.functions.ids import feed_id
from newsloom.functions.text import is_blank
from newsloom.operators import stats
from newsloom.runtime import cut
from newsloom.sources import feeds

Fetch = Callable[[str], str]


class Scanned(NamedTuple):
    """Raw items, a status for each feed, and one row that sums them up."""

    items: DataFrame
    statuses: DataFrame
    summary: DataFrame


def resolved(subscriptions: DataFrame) -> DataFrame:
    """The subscriptions with url, replaced, skip_reason, bridge_type and kind: bridged ones first, then skipped or replaced ones.

    Skipped feeds have a null url. A bridged or replaced feed is marked as replaced.
    """
    s = subscriptions.withColumns({"b": rules.bridge(F.col("xml_url"), F.col("html_url")), "r": rules.resolve(F.col("xml_url"))})
    url = F.coalesce("b.url", "r.url")
    return s.select(
        *subscriptions.columns,
        url.alias("url"),
        F.coalesce(url != F.col("xml_url"), F.lit(False)).alias("replaced"),
        F.when(url.isNull(), F.coalesce("r.reason", F.lit("skipped"))).alias("skip_reason"),
        F.col("b.bridge_type").alias("bridge_type"),
        F.coalesce("b.bridge_type", F.lit("xml")).alias("kind"),
    )


def subscribed(subscriptions: DataFrame, fetch: Fetch, now: dt.datetime, max_feeds: int = 0, tries: int = 3, wait: float = 0.8) -> Scanned:
    """All feeds of a subscription list (title, category, xml_url, html_url, ordinal), or its first ``max_feeds``.

    Each feed is bridged, replaced or skipped by the rules, read, and parsed by its kind; items without
    a date are left out. Items of a feed without category belong to the site ``opmlrss``.
    """
    if max_feeds > 0:
        subscriptions = subscriptions.orderBy("ordinal").limit(max_feeds)
    each = cut(resolved(subscriptions), "feeds")
    site = F.when(is_blank(F.col("category")), "opmlrss").otherwise(F.trim("category"))
    docs = each.where("url is not null").select(
        F.col("ordinal").cast("long").alias("doc_no"), "kind", site.alias("site_id"), F.lit("OPML RSS").alias("site_name"), F.col("title").alias("source"), "url"
    )
    read = cut(feeds.fetched(docs.repartition(F.col("doc_no")), fetch, tries, wait), "fetched")
    scanned = cut(feeds.scan(read, now), "scanned")
    outcome = feeds.statuses(scanned).select("doc_no", "ok", "n_items", "error").join(read.select("doc_no", "duration_ms"), "doc_no")
    s = each.withColumn("doc_no", F.col("ordinal").cast("long")).join(outcome, "doc_no", "left")
    skipped = F.col("url").isNull()
    statuses = s.select(
        F.when(skipped, F.col("category")).otherwise(F.concat(F.lit("opmlrss:"), feed_id(F.col("url")))).alias("site_id"),
        F.lit("OPML RSS").alias("site_name"),
        F.col("title").alias("feed_title"),
        F.col("xml_url").alias("feed_url"),
        F.col("url").alias("effective_feed_url"),
        F.coalesce("ok", F.lit(True)).alias("ok"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("duration_ms", F.lit(0)).alias("duration_ms"),
        "error",
        skipped.alias("skipped"),
        "skip_reason",
        "replaced",
        "bridge_type",
        "ordinal",
    )
    return Scanned(feeds.items(scanned), in_order(statuses), summary(statuses))


def in_order(statuses: DataFrame) -> DataFrame:
    """Feed statuses by title, or url where there is none."""
    return statuses.orderBy(F.coalesce(F.nullif(F.col("feed_title"), F.lit("")), F.col("feed_url"), F.lit("")), "ordinal")


def summary(statuses: DataFrame) -> DataFrame:
    """One row for all feeds: ok if any is, how many failed, were skipped or replaced."""
    total = statuses.agg(F.count("*").alias("feed_count"), F.count("effective_feed_url").alias("effective_feed_count"))
    both = stats.rollup(statuses).crossJoin(total)  # one row each
    return both.select(
        F.lit("opmlrss").alias("site_id"),
        F.lit("OPML RSS").alias("site_name"),
        (F.col("n_ok") > 0).alias("ok"),
        F.col("n_failed").alias("partial_failures"),
        F.when(F.col("n_failed") > 0, F.concat(F.col("n_failed").cast("string"), F.lit(" feeds failed"))).alias("error"),
        "n_items", "duration_ms", "feed_count", "effective_feed_count", F.col("n_ok").alias("ok_feed_count"), F.col("n_failed").alias("failed_feed_count"),
        F.col("n_skipped").alias("skipped_feed_count"), F.col("n_replaced").alias("replaced_feed_count"),
    )


class Branch(NamedTuple):
    """One document of a union: its kind, name, url, and the keywords of which an item must name one."""

    kind: str
    source: str
    url: str
    keywords: tuple[str, ...] | None = None


def official(spark: SparkSession, branches: Sequence[Branch], fetch: Fetch, now: dt.datetime, site_id: str = "official_ai", site_name: str = "Official AI Updates", tries: int = 1) -> DataFrame:
    """Items of all branches; one that fails gives none. If all are empty, that is an error."""
    rows = [(i, b.kind, site_id, site_name, b.source, b.url, list(b.keywords) if b.keywords is not None else None) for i, b in enumerate(branches)]
    docs = spark.createDataFrame(rows, "doc_no long, kind string, site_id string, site_name string, source string, url string, keywords array<string>")
    found = cut(feeds.items(feeds.scan(feeds.fetched(docs, fetch, tries), now)), "official")
    if found.isEmpty():
        raise ValueError(f"no items in any of {len(branches)} documents of {site_id}")
    return found


def feed_of_feeds(spark: SparkSession, page: str, fetch: Fetch, now: dt.datetime, site_id: str = "iris", site_name: str = "Info Flow") -> DataFrame:
    """Items of the feeds that a page's script names; a feed that can't be read gives none."""
    rows = [(i, "named", site_id, site_name, name, url) for i, (name, url) in enumerate(feeds.named_feeds(page))]
    docs = spark.createDataFrame(rows, "doc_no long, kind string, site_id string, site_name string, source string, url string")
    return feeds.items(feeds.scan(feeds.fetched(docs, fetch, 1), now, {"named": feeds.xml_feed}))


def or_else(first: DataFrame, second: Callable[[], DataFrame]) -> DataFrame:
    """The items of the first source, or those of the second if it has none."""
    first = cut(first, "first")
    return second() if first.isEmpty() else first


def bulk_or_each(spark: SparkSession, names: Sequence[str], bulk: str, each: Callable[[str], str], fetch: Fetch, now: dt.datetime, site_id: str = "newsnow", site_name: str = "NewsNow") -> DataFrame:
    """Items of many sources from one answer; if that can't be had, from an answer for each source."""
    ddl = "doc_no long, kind string, site_id string, site_name string, source string, url string"

    def scan(urls: list[str]) -> tuple[DataFrame, bool]:
        docs = spark.createDataFrame([(i, "aggregated", site_id, site_name, site_name, u) for i, u in enumerate(urls)], ddl)
        scanned = cut(feeds.scan(feeds.fetched(docs, fetch, 1), now), "bulk")
        return feeds.items(scanned), not feeds.statuses(scanned).where("ok").isEmpty()

    found, ok = scan([bulk])
    return found if ok else scan([each(n) for n in names])[0]
