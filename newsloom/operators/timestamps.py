"""Timestamps of many formats and zones as one UTC instant (problem 6).

All formats are one regular expression with named groups. One replacement writes the groups out as
a record, the calendar ranges are checked, and the instant is put together by day arithmetic on
integers. A wall time without offset goes through the rules of its zone: of two it takes the
earlier, in a gap the offset before the change.

Defined results: null, blank, unreadable and impossible values give null; so does an abbreviation
that is known neither to the feed's zone nor in general; a source without subscription reads as
UTC with the day first; bare numbers of fewer than nine digits denote nothing.
"""

from __future__ import annotations

import datetime as dt
import zoneinfo
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import strip
from newsloom.runtime import cut, small_side

# Month names of English, German, French and Spanish, and their usual short forms.
MONTHS = {
    1: "january januar janvier enero jan janv ene",
    2: "february februar février fevrier febrero feb févr fevr",
    3: "march märz maerz mars marzo mar mrz",
    4: "april avril abril apr avr abr",
    5: "may mai mayo",
    6: "june juni juin junio jun",
    7: "july juli juillet julio jul juil",
    8: "august août aout agosto aug ago",
    9: "september septembre septiembre setiembre sept sep",
    10: "october oktober octobre octubre oct okt",
    11: "november novembre noviembre nov",
    12: "december dezember décembre decembre diciembre dec dez déc dic",
}

# Zone abbreviations of mail headers and feeds, in minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "MEZ": 60, "CEST": 120, "MESZ": 120,
    "EET": 120, "EEST": 180, "MSK": 180, "IST": 330, "HKT": 480, "SGT": 480, "AWST": 480, "JST": 540, "KST": 540,
    "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_FIELDS = ("num", "frac", "y", "m", "d", "a", "b", "mon", "h", "mi", "s", "ap", "off", "abbr")


def _groups(n: int, **parts: str) -> dict[str, str]:
    return {k: f"(?<{k}{n}>{v})" for k, v in parts.items()}


def _pattern() -> tuple[str, dict[str, list[str]]]:
    """The alternation, and for each field the groups that may hold it."""
    clock = r"{h}[:hH]{mi}(?::{s}(?:[.,]{frac})?)?(?:\s?Uhr)?(?:\s?{ap})?(?:\s*(?:{off}|{abbr}))?(?:\s*\([A-Za-z ]+\))?(?:\s*\[?{zone}\]?)?"
    shapes = [
        r"{num}(?:\.{frac})?",
        r"{y}{m}{d}T{h}{mi}{s}?(?:{off}|{abbr})?",
        r"{y}[-/.]{m}[-/.]{d}(?:[Tt]|,?\s+|$)(?:{cjk}?" + clock + ")?",
        r"{y}年\s?{m}月\s?{d}日(?:\s*{cjk}?" + clock + ")?",
        r"{a}[/.]{b}[/.]{y}(?:,?\s+" + clock + ")?",
        r"(?:\p{{L}}+\.?,?\s+)?{d}\.?(?:\s+|-)(?:de\s+)?{mon}\.?,?(?:\s+|-)(?:de\s+)?{y}(?:(?:,|\s+à|\s+um|\s+at|\s+a\s+las)?\s+" + clock + ")?",
        r"(?:\p{{L}}+\.?,?\s+)?{mon}\.?\s+{d}(?:st|nd|rd|th)?,?\s+{y}(?:(?:,|\s+at)?\s+" + clock + ")?",
    ]
    where: dict[str, list[str]] = {f: [] for f in _FIELDS}
    done = []
    for n, shape in enumerate(shapes):
        two = n == 1
        g = _groups(
            n, num=r"-?\d{9,17}", frac=r"\d+", y=r"\d{4}", m=r"\d{2}" if two else r"\d{1,2}", d=r"\d{2}" if two else r"\d{1,2}", a=r"\d{1,2}", b=r"\d{1,2}", mon=r"\p{L}{3,}",
            h=r"\d{2}" if two else r"\d{1,2}", mi=r"\d{2}", s=r"\d{2}", ap=r"[AaPp]\.?[Mm]\.?(?![A-Za-z])", cjk="上午|下午|凌晨|早上|中午|晚上",
            off=r"(?:(?:UTC|GMT)\s?)?[+\-]\d{1,2}(?::?\d{2})?", abbr=r"[A-Za-z]{1,5}(?![A-Za-z/+\-])", zone=r"[A-Z][A-Za-z]+/[A-Za-z_/+\-]+",
        )
        done.append(shape.format(**g))
        for k in g:
            if "{" + k + "}" in shape:
                where.get("ap" if k == "cjk" else k, []).append(f"{k}{n}")
    return r"^(?:\$D)?(?:" + "|".join(done) + r")$", where


PATTERN, _WHERE = _pattern()
_RECORD = "\u0001" + "\u0001".join("".join("${%s}" % g for g in _WHERE[f]) for f in _FIELDS)


@cache
def _zone_rows() -> list[tuple[str, str, int]]:
    """(zone, abbreviation, minutes) as the zone database has them; the latest use of an abbreviation counts."""
    rows: dict[tuple[str, str], int] = {}
    for name in sorted(zoneinfo.available_timezones()):
        z = zoneinfo.ZoneInfo(name)
        for year in range(1990, 2036):
            for month in (1, 7):
                at = dt.datetime(year, month, 1, 12, tzinfo=z)
                if (abbr := at.tzname() or "").isalpha():
                    rows[name, abbr] = int(at.utcoffset().total_seconds() // 60)
    return [(z, a, m) for (z, a), m in rows.items()]


def zone_abbreviations(spark: SparkSession) -> DataFrame:
    """tz_name, abbreviations (a map to minutes): one row for each IANA zone, about 600."""
    rows: dict[str, dict[str, int]] = {}
    for z, a, m in _zone_rows():
        rows.setdefault(z, {})[a] = m
    return spark.createDataFrame(list(rows.items()), "tz_name string, abbreviations map<string,int>")


def _int(c: Column) -> Column:
    return c.try_cast("long")


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a date in the Gregorian calendar, by integers alone."""
    late = F.when(m <= 2, 1).otherwise(0)
    yy, mm = y - late, m + 12 * late - 3
    return (d - 1 + F.floor((153 * mm + 2) / 5) + 365 * yy + F.floor(yy / 4) - F.floor(yy / 100) + F.floor(yy / 400) - 719_468).cast("long")


def _month_days(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _floor_to(x: Column, by: int) -> Column:
    return ((x - F.pmod(x, F.lit(by))) / by).cast("long")


def _hour(h: Column, ap: Column) -> Column:
    """The hour of the day; null where a half of the day comes with an hour above twelve."""
    shifted = (
        F.when(ap.isin("am", "上午", "早上", "凌晨"), F.when(h == 12, 0).otherwise(h))
        .when(ap == "中午", F.when(h < 3, h + 12).otherwise(h))
        .otherwise(F.when(h == 12, 12).otherwise(h + 12))
    )
    return F.when(ap == "", F.coalesce(h, F.lit(0))).when(h <= 12, shifted)


def with_instant(rows: DataFrame, value: str, tz: str, locale: str, abbreviations: str, out: str) -> DataFrame:
    """``rows`` with ``out``: milliseconds since 1970 UTC of ``value``, or null.

    ``tz`` names the column with the zone, ``abbreviations`` a map of that zone's to minutes. The
    steps are projections of their own, so that each value is computed once.
    """
    keep = rows.columns
    rows = rows.withColumn("_r", F.split(F.regexp_replace(strip(F.col(value)), PATTERN, _RECORD), "\u0001"))
    rows = rows.select(*keep, *[F.when(F.size("_r") == len(_FIELDS) + 1, F.col("_r")[i]).alias(f"_{f}") for i, f in enumerate(_FIELDS, 1)])
    f = {k: F.col(f"_{k}") for k in _FIELDS}
    month_first = F.coalesce(F.col(locale), F.lit("")) == "en-US"
    names = F.create_map(*[x for k, v in MONTHS.items() for n in v.split() for x in (F.lit(n), F.lit(k))])
    general = F.create_map(*[x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.lit(v))])
    off = F.regexp_replace(f["off"], r"^(?:UTC|GMT)\s?|:", "")
    rows = rows.select(
        *keep,
        _int(f["num"]).alias("_num"),
        F.length(F.regexp_replace(f["num"], "-", "")).alias("_size"),
        F.when(f["frac"] != "", F.rpad(F.substring(f["frac"], 1, 3), 3, "0").cast("long")).otherwise(0).alias("_milli"),
        _int(f["y"]).alias("_y"),
        F.coalesce(_int(f["m"]), F.when(month_first, _int(f["a"])).otherwise(_int(f["b"])), F.try_element_at(names, F.lower(f["mon"])).cast("long")).alias("_m"),
        F.coalesce(_int(f["d"]), F.when(month_first, _int(f["b"])).otherwise(_int(f["a"]))).alias("_d"),
        _int(f["h"]).alias("_h"),
        F.regexp_replace(F.lower(f["ap"]), r"\.", "").alias("_ap"),
        F.coalesce(_int(f["mi"]), F.lit(0)).alias("_mi"),
        F.coalesce(_int(f["s"]), F.lit(0)).alias("_s"),
        off.alias("_off"),
        F.upper(f["abbr"]).alias("_abbr"),
        F.coalesce(F.col(tz), F.lit("UTC")).alias("_zone"),
    )
    c = {k: F.col(f"_{k}") for k in ("num", "size", "milli", "y", "m", "d", "h", "ap", "mi", "s", "off", "abbr", "zone")}
    digits = F.substring(c["off"], 2, 4)
    short = F.length(c["off"]) <= 3
    rows = rows.select(
        *keep,
        *[c[k] for k in ("num", "size", "milli", "y", "m", "d", "mi", "s", "off", "abbr", "zone")],
        _hour(c["h"], c["ap"]).alias("_hour"),
        F.when(short, digits).otherwise(F.substring(digits, F.lit(1), F.length(digits) - 2)).try_cast("long").alias("_off_h"),
        F.when(short, F.lit(0)).otherwise(F.right(digits, F.lit(2)).try_cast("long")).alias("_off_m"),
        F.coalesce(F.try_element_at(F.col(abbreviations), c["abbr"]), F.try_element_at(general, c["abbr"])).cast("long").alias("_named"),
    )
    hour = F.col("_hour")
    rows = rows.select(
        *keep,
        *[c[k] for k in ("num", "size", "milli", "off", "abbr", "zone")],
        F.when((F.col("_off_h") <= 15) & (F.col("_off_m") <= 59), F.when(c["off"].startswith("-"), -1).otherwise(1) * (F.col("_off_h") * 60 + F.col("_off_m"))).alias("_east"),
        "_named",
        F.when(
            (c["y"] >= 1) & c["m"].between(1, 12) & (c["d"] >= 1) & (c["d"] <= _month_days(c["y"], c["m"])) & hour.between(0, 23) & c["mi"].between(0, 59) & c["s"].between(0, 59),
            _days(c["y"], c["m"], c["d"]) * 86_400_000 + hour * 3_600_000 + c["mi"] * 60_000 + c["s"] * 1000 + c["milli"],
        ).alias("_wall"),
    )
    wall = F.col("_wall")
    bare = (
        F.when(c["size"] <= 11, c["num"] * 1000 + c["milli"] * F.when(c["num"] < 0, -1).otherwise(1))
        .when(c["size"] <= 14, c["num"])
        .otherwise(_floor_to(c["num"], 1000))
    )
    by_zone = _floor_to(F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall * 1000), c["zone"])), 1000)
    at = F.when(c["off"] != "", wall - F.col("_east") * 60_000).when(c["abbr"] != "", wall - F.col("_named") * 60_000).otherwise(by_zone)
    return rows.select(*keep, F.when(c["num"].isNotNull(), bare).otherwise(at).alias(out))


def normalised(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """ordinal, published_at (as it was), published_ms (null where it denotes nothing)."""
    known = feeds.where(F.col("title").isNotNull()).groupBy("title").agg(F.min(F.struct("ordinal", "tz_name", "locale")).alias("r")).select("title", "r.tz_name", "r.locale")
    zones = F.broadcast(zone_abbreviations(items.sparkSession))  # bounded by the zone database
    known = known.join(zones, "tz_name", "left").select("title", F.when(F.col("abbreviations").isNotNull(), F.col("tz_name")).alias("tz"), "locale", "abbreviations")
    rows = items.select("ordinal", "published_at", F.col("source").alias("title")).join(small_side(known), "title", "left")
    return with_instant(rows, "published_at", "tz", "locale", "abbreviations", "published_ms").select("ordinal", "published_at", "published_ms")


def changed(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """ordinal, published_ms of the readable rows that were not yet written as ``YYYY-MM-DDTHH:MM:SSZ``."""
    plain = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
    # Written first: a filter on the result would be pushed below the steps, and repeat each of them many times.
    return cut(normalised(items, feeds), "instants").where(F.col("published_ms").isNotNull() & ~F.col("published_at").rlike(plain)).select("ordinal", "published_ms")
