"""The archive by id: upsert, retention, ordering."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.ids import item_id
from newsloom.functions.text import is_blank, strip
from newsloom.functions.times import at
from newsloom.functions.urls import thumbnail

ARCHIVE_DAYS = 21
_TAKEN = ("site_id", "site_name", "source", "title", "url")


def ingestible(raw: DataFrame) -> DataFrame:
    """Rows with a title and a url that begins with http."""
    return raw.where(~is_blank(F.col("title")) & strip(F.col("url")).startswith("http"))


def with_ids(raw: DataFrame) -> DataFrame:
    return raw.withColumn("id", item_id(F.col("site_id"), F.col("source"), F.col("title"), F.col("url")))


def upsert(archive: DataFrame, raw: DataFrame, now: dt.datetime) -> DataFrame:
    """The archive after a batch of raw rows (with id and ordinal).

    Of equal ids in a batch the last gives the text fields; the first time that is known is the
    published time, the last one for plain subscriptions. A known row keeps its published time if it
    has one, except for plain subscriptions, and always its first_seen_at, star, thumbnail, summary.
    The batch is reduced to one row an id before it meets the archive, with partial aggregates.
    """
    dated = F.col("published_at").isNotNull()
    batch = raw.where("id is not null").groupBy("id").agg(
        F.max_by(F.struct(*_TAKEN), "ordinal").alias("b"),
        F.min("ordinal").alias("b_ordinal"),
        F.min_by("published_at", F.when(dated, F.col("ordinal"))).alias("b_first"),
        F.max_by("published_at", F.when(dated, F.col("ordinal"))).alias("b_last"),
    )
    old = archive.select(*[F.col(c).alias(f"a_{c}") for c in (*_TAKEN, "published_at", "first_seen_at", "last_seen_at", "star", "thumbnail", "summary", "ordinal")], F.col("id"), F.lit(True).alias("a_known"))
    j = old.join(batch, "id", "full_outer")
    new, hit = F.col("a_known").isNull(), F.col("b").isNotNull()
    clock = at(now)
    plain = F.col("b.site_id") == "opmlrss"
    published = F.when(~hit, F.col("a_published_at")).when(plain, F.coalesce("b_last", "a_published_at")).otherwise(F.coalesce("a_published_at", "b_first"))
    return j.select(
        "id",
        *[F.when(hit, F.col(f"b.{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in _TAKEN],
        published.alias("published_at"),
        F.when(new, clock).otherwise(F.col("a_first_seen_at")).alias("first_seen_at"),
        F.when(hit, clock).otherwise(F.col("a_last_seen_at")).alias("last_seen_at"),
        F.when(new, F.lit(False)).otherwise(F.col("a_star")).alias("star"),
        F.when(new, thumbnail(F.col("b.url"))).otherwise(F.col("a_thumbnail")).alias("thumbnail"),
        F.col("a_summary").alias("summary"),
        F.coalesce("a_ordinal", "b_ordinal").alias("ordinal"),
    )


def retained(archive: DataFrame, now: dt.datetime, days: int = ARCHIVE_DAYS) -> DataFrame:
    """Rows seen, published or first seen within so many days; a row without any time stays."""
    t = F.coalesce("last_seen_at", "published_at", "first_seen_at", at(now))
    return archive.where(t >= at(now - dt.timedelta(days=days)))


def latest_first(archive: DataFrame) -> DataFrame:
    return archive.orderBy(F.col("last_seen_at").desc_nulls_last(), "ordinal")


def marked_without_captions(archive: DataFrame, ids: DataFrame) -> DataFrame:
    """The archive with summary " " for the given ids, which takes them out of later selections."""
    hit = ids.select(F.col("id").alias("m_id")).distinct()
    j = archive.join(hit, archive["id"] == hit["m_id"], "left")
    return j.select(*[F.when(F.col("m_id").isNotNull(), F.lit(" ")).otherwise(F.col("summary")).alias("summary") if c == "summary" else F.col(c) for c in archive.columns])
