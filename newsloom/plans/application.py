"""The two programs: update the archive and all payloads, and fetch missing captions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import archive as archives
from newsloom.operators import captions, stats, view
from newsloom.plans import pipeline
from newsloom.runtime import cut, exists
from newsloom.sinks import payloads
from newsloom.sources import composed, feeds, files

_STATUS = "site_id string, site_name string, ok boolean, n_items long, duration_ms long, error string"
_CACHE = "title string, title_zh string"


def known_archive(spark: SparkSession, out: str) -> DataFrame:
    """The archive as the last run wrote it; empty before the first."""
    if not (exists(spark, f"{out}/archive") or exists(spark, f"{out}/archive.old")):
        return spark.createDataFrame([], files.ARCHIVE)
    text = payloads.payload(spark, f"{out}/archive", schema=files.ARCHIVE.replace(" timestamp", " string"))
    times = {c.split()[0] for c in files.ARCHIVE.split(", ") if c.endswith(" timestamp")}
    return text.select(*[F.col(c).cast("timestamp").alias(c) if c in times else F.col(c) for c in text.columns])


def known_titles(spark: SparkSession, out: str) -> DataFrame:
    if not (exists(spark, f"{out}/title-cache") or exists(spark, f"{out}/title-cache.old")):
        return spark.createDataFrame([], _CACHE)
    return payloads.payload(spark, f"{out}/title-cache", schema=_CACHE)


def update(
    spark: SparkSession, out: str, now: dt.datetime, fetch: Callable[[str], str] | None = None, opml: str | None = None, max_feeds: int = 0,
    adapters: dict[str, Callable[[], DataFrame]] | None = None, window_hours: int = view.WINDOW_HOURS, archive_days: int = archives.ARCHIVE_DAYS,
    translate: Callable[[str], str | None] | None = None, translate_max_new: int = pipeline.TRANSLATIONS, week: DataFrame | None = None,
) -> list[str]:
    """One run: adapters first, then the subscriptions, into the archive; view, stories, brief; all payloads under ``out``.

    Without sources the archive alone is evaluated anew. A list of subscriptions that isn't there is
    a status with an error. Gives the names of the payloads.
    """
    raw = spark.createDataFrame([], files.RAW).drop("meta")
    found: list[tuple] = []
    feed_statuses = None
    if adapters:
        rows, outcomes = feeds.collect(adapters)
        if rows is not None:
            raw = raw.unionByName(rows.select(*raw.columns))
        found += [(s["site_id"], s["site_id"], s["ok"], s["n_items"], 0, s["error"]) for s in outcomes]
    statuses = spark.createDataFrame(found, _STATUS)
    if opml is not None:
        if not exists(spark, opml):
            missing = [("opmlrss", "OPML RSS", False, 0, 0, f"OPML not found: {opml}")]
            statuses = statuses.unionByName(spark.createDataFrame(missing, _STATUS))
        elif fetch is None:
            raise ValueError("subscriptions need a function that fetches")
        else:
            got = composed.subscribed(files.read_opml(spark, opml), fetch, now, max_feeds)
            # Behind the adapters' rows in order of arrival.
            raw = raw.unionByName(got.items.withColumn("ordinal", F.col("ordinal") + (1 << 40)).select(*raw.columns))
            statuses = statuses.unionByName(got.summary.select(*[c.split()[0] for c in _STATUS.split(", ")]))
            feed_statuses = got.statuses
    state = known_archive(spark, out)
    last = state.agg(F.coalesce(F.max("ordinal"), F.lit(0))).first()[0]
    raw = cut(raw.withColumn("ordinal", F.col("ordinal") + last + 1), "raw")
    r = pipeline.run(state, raw, now, window_hours, archive_days, known_titles(spark, out), translate, translate_max_new)
    if week is None:
        week = spark.createDataFrame([(False, "no page was given")], "ok boolean, error string")
    names = payloads.write_all(out, r.items, r.shown, r.stories, r.events, r.archive, statuses, r.cache, week, now, window_hours)
    payloads.swap_in(status_payload(statuses), f"{out}/status-summary")
    if feed_statuses is not None:
        payloads.swap_in(feed_statuses, f"{out}/feed-status")
        names.append("feed-status")
    return [*names, "status-summary"]


def status_payload(statuses: DataFrame) -> DataFrame:
    """One row: how many sites there are, were read and failed, items in all, and the names of those that failed or gave nothing."""
    total = statuses.agg(F.count("*").alias("n_sites"), F.count_if("ok").alias("n_ok"), F.coalesce(F.sum("n_items"), F.lit(0)).alias("n_items"))
    return total.crossJoin(stats.failed_and_empty(statuses))  # one row each


#: What a downloader may say of an item.
OUTCOMES = ("done", "none", "failed", "stop")


def fetch_captions(spark: SparkSession, archive: DataFrame, folder: str, download: Callable[[str, str], str], most: int = 70) -> tuple[DataFrame, dict[str, int]]:
    """(archive, counts) after captions of at most so many videos were asked for, in the archive's order.

    ``download(id, url)`` does one and says "done", "none" (there are none: the item is marked, so that
    it is never asked for again), "failed", or "stop", which ends the run. The run is as slow as the
    downloader; only the selection is a job.
    """
    known = files.captioned(spark, folder) if exists(spark, folder) else spark.createDataFrame([], "item_id string")
    counts = dict.fromkeys(OUTCOMES, 0)
    without: list[tuple[str]] = []
    for r in captions.pending(archive, known, most).select("id", "url").toLocalIterator():
        outcome = download(r.id, r.url)
        counts[outcome] += 1
        if outcome == "stop":
            break
        if outcome == "none":
            without.append((r.id,))
    return (archives.marked_without_captions(archive, spark.createDataFrame(without, "id string")) if without else archive), counts


def main(argv: Sequence[str], fetch: Callable[[str], str] | None = None, download: Callable[[str, str], str] | None = None, spark: SparkSession | None = None) -> int:
    """The command line; ``fetch`` and ``download`` are what reaches the network."""
    import argparse

    from newsloom.runtime import local_session

    top = argparse.ArgumentParser(prog="newsloom")
    do = top.add_subparsers(dest="what", required=True)
    u = do.add_parser("update", help="read the sources, bring the archive up to date, write all payloads")
    u.add_argument("--output-dir", default="data")
    u.add_argument("--window-hours", type=int, default=view.WINDOW_HOURS)
    u.add_argument("--archive-days", type=int, default=archives.ARCHIVE_DAYS)
    u.add_argument("--rss-opml", default="")
    u.add_argument("--rss-max-feeds", type=int, default=0)
    u.add_argument("--now", default="", help="the clock of the run as ISO text; the wall clock if empty")
    c = do.add_parser("captions", help="fetch captions of videos that have none")
    c.add_argument("--output-dir", default="data", help="where the archive lies")
    c.add_argument("--captions-dir", required=True)
    c.add_argument("--max-items", type=int, default=70)
    a = top.parse_args(argv)
    spark = spark or local_session()
    if a.what == "update":
        now = dt.datetime.fromisoformat(a.now) if a.now else dt.datetime.now(dt.timezone.utc)
        names = update(spark, a.output_dir, now, fetch or http_get, a.rss_opml or None, max(0, a.rss_max_feeds), window_hours=a.window_hours, archive_days=a.archive_days)
        print(f"{len(names)} payloads in {a.output_dir}")
        return 0
    if download is None:
        top.error("captions need a downloader, which the caller of main passes")
    archive, counts = fetch_captions(spark, known_archive(spark, a.output_dir), a.captions_dir, download, a.max_items)
    if counts["none"]:
        payloads.swap_in(payloads.as_text(archive), f"{a.output_dir}/archive")
    print("Done. " + " ".join(f"{k}={n}" for k, n in counts.items()))
    return 0


def http_get(url: str, timeout: float = 12.0) -> str:
    """A page as text; its errors carry a status code."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as r:  # noqa: S310
        return r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
