"""Queries of the general operators for training data, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.operators import format_dedup, late_events, timestamps
from newsloom.runtime import scratch, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_events.replay(table(spark, sf_dir, "archive_item"), scratch(spark, "late")).late()


def p2_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_events.replay(table(spark, sf_dir, "archive_item"), scratch(spark, "late")).daily()


def p2_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view after two batches and a recompute in between; the second batch is provisional.

    Rows without first_seen_at count as on time and are in the first batch, before anything is frozen.
    """
    log = table(spark, sf_dir, "archive_item")
    clocks = [r[0] for r in log.select("first_seen_at").where("first_seen_at is not null").distinct().orderBy("first_seen_at").collect()]  # one row a run
    view = late_events.LambdaView(spark, scratch(spark, "late"))
    if not clocks:
        view.ingest(log)
        return view.serve()
    middle = clocks[len(clocks) // 2]
    view.ingest(log.where((log.first_seen_at < middle) | log.first_seen_at.isNull()))
    view.recompute(middle)
    view.ingest(log.where(log.first_seen_at >= middle))
    return view.serve()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.changed(table(spark, sf_dir, "raw_item"), table(spark, sf_dir, "feed_subscription"))


def p6_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps.normalised(table(spark, sf_dir, "raw_item"), table(spark, sf_dir, "feed_subscription")).select("ordinal", "published_ms")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_dedup.copies(table(spark, sf_dir, "raw_item"))


def p7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_dedup.records(table(spark, sf_dir, "raw_item"))


_SIGHTED = """
SELECT ordinal, epoch_us(first_seen_at) - (epoch_us(date_trunc('day', published_at)) + 86400000000) AS late,
       strftime(published_at, '%Y-%m-%d') AS period_day
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ordinal) AS rn FROM archive_item WHERE published_at IS NOT NULL AND id IS NOT NULL)
WHERE rn = 1
"""

_WS = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
_LETTERS = "regexp_replace(replace(lower({t}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_A, _B = _LETTERS.format(t="split_part(title, '|', 1)"), _LETTERS.format(t="split_part(title, '|', 2)")
#: Rows that can be compared, with their keys; titles have at most one bar in these tables.
_SPELLED = f"""
SELECT ordinal, CASE WHEN contains(title, '|') THEN least({_A} || {_B}, {_B} || {_A}) ELSE {_LETTERS.format(t='title')} END AS t,
 lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) || ' ' || lower(regexp_extract(u, '^[A-Za-z]+://([^/?#]*)', 1)) || ' ' || url_decode(regexp_replace(regexp_extract(u, '^(?:[A-Za-z]+://[^/?#]*)?([^?#]*)', 1), '/$', ''))
 || ' ' || array_to_string(list_sort(list_transform(list_filter(string_split(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> ''), lambda p: url_decode(p))), '&') || ' ' || regexp_extract(u, '#(.*)$', 1) AS k
FROM (SELECT ordinal, title, regexp_replace(url, '^{_WS}+|{_WS}+$', '', 'g') AS u FROM raw_item WHERE regexp_replace(title, '{_WS}+', '', 'g') <> '') WHERE u <> ''
"""

ORACLE = {
    "p7_found": f"SELECT first_ordinal, ordinal AS copy_ordinal FROM (SELECT ordinal, min(ordinal) OVER (PARTITION BY t, k) AS first_ordinal FROM ({_SPELLED})) WHERE ordinal <> first_ordinal",
    "p7_records": f"SELECT min(ordinal) AS first_ordinal, count(*) AS n_copies FROM ({_SPELLED}) GROUP BY t, k",
    "p2_found": f"SELECT ordinal, period_day, CASE WHEN late <= 172800000000 THEN 'corrects' ELSE 'too_late' END AS verdict FROM ({_SIGHTED}) WHERE late >= 0",
    "p2_daily": f"""
SELECT period_day, count(*) FILTER (late < 0 OR late IS NULL) AS n_on_time, count(*) FILTER (late BETWEEN 0 AND 172800000000) AS n_corrects,
       count(*) FILTER (late > 172800000000) AS n_too_late, count(*) FILTER (late <= 172800000000 OR late IS NULL) AS n_items
FROM ({_SIGHTED}) GROUP BY period_day""",
}


def queries() -> dict:
    return {n: f for n, f in globals().items() if n.startswith("p") and n[1:2].isdigit() and callable(f)}
