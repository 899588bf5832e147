"""Time columns: event time, recency, ISO text, unix numbers, dates in headings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(now: dt.datetime) -> Column:
    """A clock as a literal; the engine never asks the wall clock."""
    return F.lit(now).cast("timestamp")


def iso(t: Column) -> Column:
    """ISO text in UTC with ``Z``; a fraction only if there is one."""
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    return F.concat(whole, F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def from_unix(n: Column) -> Column:
    """Seconds since 1970, milliseconds above ten billion."""
    x = n.try_cast("double")
    return F.timestamp_micros((F.when(x > 1e10, x / 1000).otherwise(x) * 1e6).cast("long"))


def parse(s: Column) -> Column:
    """ISO text, unix numbers and the twelve-hour form with ``UTC``; null if it is none of these."""
    t = F.regexp_replace(F.trim(s), r"^\$D", "")
    half = F.regexp_extract(t, r"(\d{4}-\d{2}-\d{2}\s+\d{1,2}:\d{2}:\d{2}[AP]M)\s+UTC", 1)
    return F.coalesce(F.when(t.rlike(r"^\d{9,}$"), from_unix(t)), F.try_to_timestamp(F.nullif(half, F.lit("")), F.lit("yyyy-MM-dd h:mm:ssa")), t.try_cast("timestamp"))


def event_time(site_id: Column, published: Column, first_seen: Column) -> Column:
    """Published, else first seen; for plain subscriptions published alone."""
    return F.when(site_id == "opmlrss", published).otherwise(F.coalesce(published, first_seen))


def recency(t: Column, now: dt.datetime, window_hours: float) -> Column:
    """One now, falling in a line to zero at the window's end; the future counts as now, null as nothing."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(at(now)) - F.unix_micros(t)) / 3.6e9)
    left = (F.lit(float(window_hours)) - age) / max(1.0, float(window_hours))
    return F.when(t.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), left)))


def year_month(heading: Column) -> Column:
    """(year, month) of a heading such as 2025年3月."""
    y = F.regexp_extract(heading, r"(20\d{2})\s*年\s*(\d{1,2})\s*月", 1)
    return F.when(y != "", F.struct(y.try_cast("int").alias("year"), F.regexp_extract(heading, r"(20\d{2})\s*年\s*(\d{1,2})\s*月", 2).try_cast("int").alias("month")))


def month_day(heading: Column) -> Column:
    """(month, day) of a heading such as 3 月 5 日."""
    m = F.regexp_extract(heading, r"(\d{1,2})\s*月\s*(\d{1,2})\s*日", 1)
    return F.when(m != "", F.struct(m.try_cast("int").alias("month"), F.regexp_extract(heading, r"(\d{1,2})\s*月\s*(\d{1,2})\s*日", 2).try_cast("int").alias("day")))


def date_near(month: Column, day: Column, today: dt.date) -> Column:
    """The date of this year, or of last year if that lies more than two days ahead; null if there is none."""

    def of(year: int) -> Column:
        return F.to_date(F.try_to_timestamp(F.concat_ws("-", F.lit(year), month, day), F.lit("yyyy-M-d")))

    this = of(today.year)
    return F.when(this > F.lit(today + dt.timedelta(days=2)), of(today.year - 1)).otherwise(this)
