"""Problem 6 against the standard library's zones, and cases by hand."""

import datetime as dt
import zoneinfo

import pytest
from pyspark.sql import functions as F

from newsloom.operators import timestamps

UTC = dt.timezone.utc
FEEDS = [("us", "America/New_York", "en-US"), ("gb", "Europe/London", "en-GB"), ("de", "Europe/Berlin", "de-DE"), ("cn", "Asia/Shanghai", "zh-CN"), ("in", "Asia/Kolkata", "en-IN"), ("odd", "No/Where", "xx"), ("none", None, None)]


def run(spark, cases):
    feeds = spark.createDataFrame([(i, t, z, loc) for i, (t, z, loc) in enumerate(FEEDS)], "ordinal int, title string, tz_name string, locale string")
    rows = spark.createDataFrame([(i, s, v) for i, (s, v) in enumerate(cases)], "ordinal long, source string, published_at string")
    return {r.ordinal: r.published_ms for r in timestamps.normalised(rows, feeds).collect()}


def ms(y, m, d, h=0, mi=0, s=0, zone="UTC", milli=0):
    z = zoneinfo.ZoneInfo(zone)
    return int(dt.datetime(y, m, d, h, mi, s, tzinfo=z).timestamp() * 1000) + milli


CASES = [
    ("us", "11/02/2025 01:35", ms(2025, 11, 2, 1, 35, zone="America/New_York")),  # occurred twice: the earlier
    ("us", "03/09/2025 02:30", ms(2025, 3, 9, 7, 30)),  # skipped: offset before the change
    ("gb", "30/03/2025 01:30", ms(2025, 3, 30, 1, 30)),
    ("gb", "26/10/2025 01:30", ms(2025, 10, 26, 0, 30)),
    ("us", "21/10/2025 01:26", None),  # no month 21
    ("gb", "21/10/2025 01:26", ms(2025, 10, 21, 0, 26)),
    ("cn", "Wed, 05 Nov 2025 13:23:52 CST", ms(2025, 11, 5, 5, 23, 52)),
    ("us", "Wed, 05 Nov 2025 13:23:52 EST", ms(2025, 11, 5, 18, 23, 52)),
    ("de", "Wed, 05 Nov 2025 13:23:52 CST", ms(2025, 11, 5, 19, 23, 52)),
    ("in", "Wed 5 Nov 2025 13:23:52 IST", ms(2025, 11, 5, 7, 53, 52)),
    ("us", "Wed, 05 Nov 2025 13:23:52 QQT", None),
    ("us", "2025-10-18 09:44:09PM UTC", ms(2025, 10, 18, 21, 44, 9)),
    ("us", "2025-10-18 12:44:09AM UTC", ms(2025, 10, 18, 0, 44, 9)),
    ("us", "2025-10-18 13:44:09PM UTC", None),
    ("cn", "2025-10-28 下午12:30", ms(2025, 10, 28, 4, 30)),
    ("cn", "2025年10月28日 15:05", ms(2025, 10, 28, 7, 5)),
    ("de", "11. November 2025, 16:04 Uhr", ms(2025, 11, 11, 15, 4)),
    ("de", "24 de octubre de 2025, 17:29", ms(2025, 10, 24, 15, 29)),
    ("de", "16 octobre 2025 à 23h59", ms(2025, 10, 16, 21, 59)),
    ("us", "November 3, 2025 at 12:52 PM", ms(2025, 11, 3, 17, 52)),
    ("us", "2025-11-03T19:17:13.975579194+11:00", ms(2025, 11, 3, 8, 17, 13, milli=975)),
    ("us", "2025-11-03T03:46:59+11:00 Australia/Sydney", ms(2025, 11, 2, 16, 46, 59)),
    ("us", "2025-11-03T03:46:59+11:00[Australia/Sydney]", ms(2025, 11, 2, 16, 46, 59)),
    ("in", "2025-10-23 11:02:47 UTC+5:30", ms(2025, 10, 23, 5, 32, 47)),
    ("us", "2025-10-24 19:11:42 UTC-7", ms(2025, 10, 25, 2, 11, 42)),
    ("us", "Tue, 11 Nov 2025 12:20:26 +0000 (UTC)", ms(2025, 11, 11, 12, 20, 26)),
    ("cn", "20251105T172314", ms(2025, 11, 5, 9, 23, 14)),
    ("us", "1761166766.909", 1761166766909),
    ("us", "1760623898646400", 1760623898646),
    ("us", "1762657350189", 1762657350189),
    ("us", "1761764409", 1761764409000),
    ("us", "$D2025-10-29T20:14:15.358Z", ms(2025, 10, 29, 20, 14, 15, milli=358)),
    ("us", "2025-02-30", None),
    ("us", "2024-02-29", ms(2024, 2, 29, zone="America/New_York")),
    ("us", "2025-13-41T10:00:00Z", None),
    ("us", "2025-10-27T27:61:00Z", None),
    ("us", "0000-00-00 00:00:00", None),
    ("us", "2025-10-24T10:00:00+99:99", None),
    ("odd", "2025-10-24 10:00:00", ms(2025, 10, 24, 10)),
    ("none", "2025-10-24 10:00:00", ms(2025, 10, 24, 10)),
    ("stranger", "21/10/2025 10:00", ms(2025, 10, 21, 10)),
    (None, "2025-10-24 10:00:00", ms(2025, 10, 24, 10)),
    ("us", None, None), ("us", "", None), ("us", " ", None), ("us", "tbd", None), ("us", "N/A", None), ("us", "-", None), ("us", "x" * 100_000, None),
]


def test_cases(spark):
    got = run(spark, [(s, v) for s, v, _ in CASES])
    wrong = [(c, got[i]) for i, c in enumerate(CASES) if got[i] != c[2]]
    assert not wrong, wrong


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin"])
def test_each_hour_around_clock_changes(spark, zone):
    feed = {"America/New_York": "us", "Europe/Berlin": "de"}[zone]
    z = zoneinfo.ZoneInfo(zone)
    start = [dt.datetime(2025, 3, 8), dt.datetime(2025, 11, 1), dt.datetime(2025, 3, 29), dt.datetime(2025, 10, 25)]
    walls = [s + dt.timedelta(minutes=30 * k) for s in start for k in range(100)]
    got = run(spark, [(feed, w.strftime("%Y-%m-%d %H:%M:%S")) for w in walls])
    for i, w in enumerate(walls):
        # fold=0: of two the earlier, in a gap the offset before it.
        assert got[i] == int(w.replace(tzinfo=z, fold=0).timestamp() * 1000), w


def test_changed_leaves_out_the_plain_form_and_keeps_rows(spark):
    feeds = spark.createDataFrame([(0, "us", "America/New_York", "en-US")], "ordinal int, title string, tz_name string, locale string")
    rows = spark.createDataFrame(
        [(1, "us", "2025-10-29T09:31:24Z", "a"), (2, "us", " 2025-10-29T09:31:24Z", "b"), (3, "us", "2025-10-29T09:31:24.0Z", "c"), (3, "us", "2025-10-29T09:31:24.0Z", "c")],
        "ordinal long, source string, published_at string, tz string",
    )
    got = sorted(r.ordinal for r in timestamps.changed(rows, feeds).collect())
    assert got == [2, 3, 3]
    assert timestamps.changed(rows.limit(0), feeds).count() == 0
    assert timestamps.changed(rows, feeds.limit(0)).count() == 3


def test_calendar_arithmetic(spark):
    days = spark.range(-800_000, 800_000, 997).select(F.col("id").alias("n"), F.date_from_unix_date(F.col("id").cast("int")).alias("d"))
    own = days.where("d >= '0001-01-01'").select("n", timestamps._days(F.year("d").cast("long"), F.month("d").cast("long"), F.day("d").cast("long")).alias("m"))
    assert own.where("n <> m").count() == 0
