"""Repeats among display items: exact ones, generic titles, near ones of a site."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import titles
from newsloom.functions.udf import similarity_from
from newsloom.operators.components import components
from newsloom.operators.view import dedup_key
from newsloom.runtime import cut, ranked

NEAR_HOURS, NEAR_SIMILARITY, NEAR_JACCARD, LOOKBACK = 6.0, 0.9, 0.5, 60
#: Pairs of which the components go to one task together.
GROUPED = 20_000


def _best(df: DataFrame, key: str, *rank) -> DataFrame:
    """The row of each key that ranks highest: a partial aggregate, so a key with very many rows costs one a task."""
    fields = [F.col(f"`{c}`") for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*rank)).alias("r"))
    return best.select(key, "r.*")


def distinct_items(items: DataFrame, seed: int | None = None) -> DataFrame:
    """One item for each title and page: the latest (then the greatest id); with a seed, one by a seeded hash."""
    keyed = items.withColumn("_key", dedup_key(F.col("site_id"), F.coalesce("title_original", "title") if "title_original" in items.columns else F.col("title"), F.col("url")))
    first = [F.xxhash64("id", F.lit(seed))] if seed is not None else [F.col("event_at").isNotNull(), F.col("event_at")]
    return _best(keyed, "_key", *first, "id", "ordinal").drop("_key")


def daily_items(items: DataFrame, site: str = "aihubtoday") -> DataFrame:
    """Of one site, an item a url, titles that say something first; other sites pass."""
    title = F.coalesce("title", F.lit(""))
    generic = (F.trim(title) == "") | F.lower(F.trim(title)).isin("阅读全文", "查看详情", "more", "read more") | title.rlike(r"\(AI资讯\)\s*$")
    here = items.where((F.col("site_id") == site) & (F.trim("url") != ""))
    best = _best(here, "url", ~generic, F.col("event_at").isNotNull(), "event_at", "id", "ordinal")
    return items.where(F.coalesce(F.col("site_id") != site, F.lit(True))).unionByName(best.select(*items.columns))


def latest_first(items: DataFrame) -> DataFrame:
    return items.orderBy(F.col("event_at").desc_nulls_last(), "ordinal")


def _edges(slim: DataFrame) -> DataFrame:
    """place, o_place: pairs of one site that are alike and near in time, the later one first.

    Titles that share half their words share one among the n - ceil(n / 2) + 1 rarest of each, so
    candidates come from an equi-join on site, bucket of time and such a word; a word that very many
    titles share is nobody's rarest. Items without time meet those of all buckets.
    """
    words = slim.select("place", "site", F.explode("words").alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("df"))
    order = words.join(often, "word").groupBy("place").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("r"))  # the words of one title
    n = F.size("r")
    rare = F.slice("r", F.lit(1), n - F.ceil(n * NEAR_JACCARD).cast("int") + 1)
    bucket = F.floor(F.col("at") / (NEAR_HOURS * 3.6e9))
    side = slim.select("place", "site", "at", "mergeable", bucket.alias("bucket")).join(order.select("place", F.explode(F.transform(rare, lambda x: x["word"])).alias("word")), "place")
    other = side.select("site", "word", "bucket", F.col("place").alias("o_place"), F.col("at").alias("o_at"))
    near = other.where("o_at is not null").withColumn("bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"))))
    near = near.unionByName(other.where("o_at is not null").withColumn("bucket", F.col("bucket") + 1))
    mine = side.where("mergeable").drop("mergeable")
    met = mine.where("at is not null").join(near, ["site", "word", "bucket"]).select("place", "at", "o_place", "o_at")
    met = met.unionByName(mine.join(other.where("o_at is null").drop("bucket"), ["site", "word"]).select("place", "at", "o_place", "o_at"))
    close = F.coalesce(F.abs(F.col("at") - F.col("o_at")) <= NEAR_HOURS * 3.6e9, F.lit(True))
    pairs = met.where((F.col("o_place") < F.col("place")) & close).select("place", "o_place").distinct()
    a = slim.select("place", "story_title", "words", "vendors", "models")
    full = pairs.join(a, "place").join(a.select(*[F.col(c).alias(f"o_{c}") for c in a.columns]), "o_place")
    j = titles.jaccard(F.col("words"), F.col("o_words"))
    full = full.where((j >= NEAR_JACCARD) & titles.compatible(F.col("vendors"), F.col("o_vendors")) & titles.compatible(F.col("models"), F.col("o_models")))
    return full.where(similarity_from(F.col("story_title"), F.col("o_story_title"), j, F.lit(NEAR_SIMILARITY)) >= NEAR_SIMILARITY).select("place", "o_place")


def _ruled(pdf: pd.DataFrame, lookback: int) -> pd.DataFrame:
    """The sequential rule over components: which items met a kept one (they take no slot of their own), and which leave."""
    rows = []
    for _, part in pdf.groupby("root", sort=False):
        kept: list[list] = []  # (slot, item that holds it), ascending
        for r in part.sort_values("place").itertuples(index=False):
            mine = set(r.edges) if r.edges is not None else ()
            hit = next((k for k in reversed(kept) if k[1].place in mine and k[0] >= r.slot - lookback), None) if mine else None
            if hit is None:
                kept.append([r.slot, r])
                continue
            o, late = hit[1], float("inf")
            better = (-r.rank, -(r.at if r.at == r.at else late)) > (-o.rank, -(o.at if o.at == o.at else late))
            rows.append((r.place, o.place if better else r.place))
            if better:
                hit[1] = r
    return pd.DataFrame(rows, columns=["place", "gone"]).astype({"place": "int64", "gone": "int64"})


def near_repeats(items: DataFrame) -> DataFrame:
    """id of the items that nearly repeat one of the same site within six hours.

    The sequential rule (an item against the kept ones before it, the newest first, no more than 60
    back) runs inside the components of the pairs that are alike: an item can only meet what it has a
    pair with. How many kept ones lie between two items depends on other components too; if that
    matters for any pair, the rule is run again with what the last round kept, until nothing changes.
    """
    title = titles.story_title(F.col("title"), F.col("title_bilingual") if "title_bilingual" in items.columns else None)
    slim = items.select("id", "ordinal", F.coalesce("site_id", F.lit("")).alias("site"), F.unix_micros("event_at").alias("at"), F.coalesce("source_tier_rank", F.lit(99)).alias("rank"), title.alias("story_title"))
    slim = ranked(slim.orderBy("site", F.col("at").asc_nulls_first(), "ordinal"))
    slim = slim.withColumn("words", titles.tokens(F.col("story_title")))
    slim = cut(slim.withColumns({"mergeable": titles.mergeable(F.col("story_title"), F.col("words")), "vendors": titles.vendors(F.col("story_title")), "models": titles.models(F.col("story_title"))}), "slim")
    edges = cut(_edges(slim), "edges")
    n = edges.count()
    none = items.sparkSession.createDataFrame([], "id string")
    if not n:
        return none
    far = not edges.where(F.col("place") - F.col("o_place") > LOOKBACK).isEmpty()
    roots = components(edges.select(F.col("place").alias("u"), F.col("o_place").alias("v")))
    touched = roots.select(F.col("u").alias("place"), "root").unionByName(roots.select(F.col("root").alias("place"), "root").distinct())
    each = slim.select("place", "site", "at", "rank").join(touched, "place").join(edges.groupBy("place").agg(F.collect_list("o_place").alias("edges")), "place", "left")
    each = cut(each, "touched")
    groups = max(1, -(-n // GROUPED))
    absorbed: DataFrame | None = None
    lookback = LOOKBACK
    before = None
    while True:
        slots = each.withColumn("slot", F.col("place"))
        if absorbed is not None:  # a running count, of one number a row
            w = Window.partitionBy("site").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
            slots = each.join(absorbed.select("place", F.lit(1).alias("in")), "place", "left").withColumn("slot", F.col("place") - F.coalesce(F.sum("in").over(w), F.lit(0))).drop("in")
        ruled = slots.select("place", "at", "rank", "root", "edges", "slot").groupBy(F.pmod(F.xxhash64("root"), F.lit(groups)).alias("g")).applyInPandas(lambda pdf: _ruled(pdf, lookback), "place long, gone long")
        absorbed = cut(ruled, "ruled")
        if not far:
            break
        state = absorbed.agg(F.count("*"), F.bit_xor(F.xxhash64("place", "gone"))).first()
        if state == before:
            break
        before = state
    return slim.join(absorbed.select(F.col("gone").alias("place")), "place", "left_semi").select("id")


def without(items: DataFrame, ids: DataFrame) -> DataFrame:
    return items.join(ids.select("id").distinct(), "id", "left_anti")


def suppressed(items: DataFrame) -> DataFrame:
    """Items without near repeats."""
    return without(items, near_repeats(items))
