"""Items merged into stories; stories scored; a brief picked from them.

The sequential rule is: in order of time an item joins the story of its canonical url, else the
first story whose founding title is close in time and wording, else it founds one. It is computed
without a global pass: an item whose canonical url came before follows that one; among the rest,
candidate pairs come from an equi-join on shared words in neighbouring time buckets, pairs that
pass the exact test are edges, and the rule runs inside each connected component of the edges,
which gives the same stories, as an item can join only what it has an edge with.

One deviation: two titles that share no word (no pair of Han) are never compared.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import titles
from newsloom.functions.ids import story_id
from newsloom.functions.times import recency
from newsloom.functions.udf import ratio, similarity_from
from newsloom.functions.urls import IDENTITY_KEYS, canonical_story_url
from newsloom.operators.components import components
from newsloom.plans.dims import LABELS, importance_of, tier
from newsloom.runtime import cut

MERGE_HOURS, MERGE_SIMILARITY = 6, 0.86
#: Least ratio of lengths of two titles that can reach the similarity: the matching ratio must be 0.7666.
LENGTHS = 0.62
#: Pairs of which the components go to one task together.
GROUPED = 20_000
GATE, LIMIT, PENALTY, PICK_JACCARD = 0.72, 20, 0.03, 0.4
#: Stories that come to the driver at a time; of a source no more are kept before the shuffle, which Spark does up to 1,000.
BLOCK = 1_000


def _prepared(items: DataFrame, identity: tuple[str, ...]) -> DataFrame:
    title = titles.story_title(F.col("title"), F.col("title_bilingual") if "title_bilingual" in items.columns else None)
    d = items.select("id", "ordinal", F.unix_micros("event_at").alias("at"), canonical_story_url(F.coalesce("url", F.lit("")), identity).alias("page"), title.alias("story_title"), story_id(F.col("url"), F.col("title"), F.col("id")).alias("own_story"))
    d = d.withColumn("words", titles.tokens(F.col("story_title")))
    return d.withColumns({"mergeable": titles.mergeable(F.col("story_title"), F.col("words")), "vendors": titles.vendors(F.col("story_title")), "models": titles.models(F.col("story_title"))})


def _edges(firsts: DataFrame) -> DataFrame:
    """later, earlier, similarity of the pairs whose titles may be one story."""
    bucket = F.floor(F.coalesce("at", F.lit(0)) / (MERGE_HOURS * 3_600_000_000))
    pairs_of_han = F.filter(F.flatten(F.transform(F.regexp_extract_all("story_title", F.lit(f"([{titles.HAN}]{{2,}})"), F.lit(1)), lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2))))), lambda x: x.isNotNull())
    keyed = firsts.withColumns({"bucket": bucket, "keys": F.array_distinct(F.concat(F.filter("words", lambda w: ~w.rlike(f"[{titles.HAN}]")), pairs_of_han)), "n": F.length("story_title")})
    side = keyed.select("ordinal", "at", "bucket", "n", "mergeable", F.explode("keys").alias("key"))
    other = side.select(*[F.col(c).alias(f"o_{c}") for c in ("ordinal", "at", "n")], "key", "bucket")
    near = other.where("o_at is not null").withColumn("bucket", F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)))
    mine = side.where("mergeable")
    # An item without time comes before all others and is near to each.
    met = mine.where("at is not null").join(near, ["bucket", "key"]).unionByName(mine.join(other.where("o_at is null").drop("bucket"), "key"))
    earlier = (F.coalesce("o_at", F.lit(-1)) < F.coalesce("at", F.lit(-1))) | (F.col("o_at").eqNullSafe(F.col("at")) & (F.col("o_ordinal") < F.col("ordinal")))
    close = F.abs(F.col("at") - F.col("o_at")) <= MERGE_HOURS * 3_600_000_000
    pairs = met.where(earlier & F.coalesce(close, F.lit(True)) & (F.least("n", "o_n") >= LENGTHS * F.greatest("n", "o_n"))).select("ordinal", "o_ordinal").distinct()
    a = firsts.select("ordinal", "story_title", "words", "vendors", "models")
    b = a.select(*[F.col(c).alias(f"o_{c}") for c in a.columns])
    full = pairs.join(a, "ordinal").join(b, "o_ordinal")
    full = full.where(titles.compatible(F.col("vendors"), F.col("o_vendors")) & titles.compatible(F.col("models"), F.col("o_models")))
    j = F.when((F.size("words") > 0) & (F.size("o_words") > 0), titles.jaccard(F.col("words"), F.col("o_words")))
    scored = full.withColumn("similarity", similarity_from(F.col("story_title"), F.col("o_story_title"), j, F.lit(MERGE_SIMILARITY)))
    return scored.where(F.col("similarity") >= MERGE_SIMILARITY).select("ordinal", "o_ordinal", "similarity")


def _founders(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sequential rule over components: each item with the founder it joins."""
    rows = []
    for _, part in pdf.groupby("root", sort=False):
        rows += _founders_of(part)
    return pd.DataFrame(rows, columns=["ordinal", "founder", "similarity"]).astype({"ordinal": "int64", "founder": "int64", "similarity": "float64"})


def _founders_of(part: pd.DataFrame) -> list[tuple[int, int, float]]:
    founders: list[int] = []
    known: set[int] = set()
    rows = []
    for r in part.sort_values(["at", "ordinal"], na_position="first").itertuples(index=False):
        mine = {e["o"]: e["s"] for e in (r.edges if r.edges is not None else [])}
        hit = next((f for f in founders if f in mine), None) if known & mine.keys() else None
        if hit is None:
            founders.append(r.ordinal)
            known.add(r.ordinal)
        rows.append((r.ordinal, r.ordinal if hit is None else hit, 1.0 if hit is None else mine[hit]))
    return rows


def merged(items: DataFrame, identity: tuple[str, ...] = IDENTITY_KEYS) -> DataFrame:
    """id, ordinal, story_id, reason (founder, canonical_url, title_similarity), similarity of every item."""
    d = cut(_prepared(items, identity), "stories")
    # The first item of each page; pages that are blank stand alone.
    order = F.struct(F.coalesce("at", F.lit(-(1 << 62))), F.col("ordinal"))
    first = d.where("page <> ''").groupBy("page").agg(F.min_by("ordinal", order).alias("head"))
    d = d.join(first, "page", "left").withColumn("head", F.coalesce("head", "ordinal"))
    firsts = cut(d.where("head = ordinal"), "firsts")
    edges = cut(_edges(firsts), "edges")
    roots = components(edges.select(F.col("ordinal").alias("u"), F.col("o_ordinal").alias("v")))
    both = edges.groupBy("ordinal").agg(F.collect_list(F.struct(F.col("o_ordinal").alias("o"), F.col("similarity").alias("s"))).alias("edges"))
    touched = roots.select(F.col("u").alias("ordinal"), "root").union(roots.select("root", "root").distinct())
    inside = firsts.select("ordinal", "at").join(touched, "ordinal").join(both, "ordinal", "left")
    groups = max(1, -(-edges.count() // GROUPED))
    ruled = inside.groupBy(F.pmod(F.xxhash64("root"), F.lit(groups)).alias("g")).applyInPandas(lambda pdf: _founders(pdf), "ordinal long, founder long, similarity double")
    heads = firsts.select("ordinal", "own_story").join(ruled, "ordinal", "left").select(
        F.col("ordinal").alias("head"), F.coalesce("founder", "ordinal").alias("founder"), F.coalesce("similarity", F.lit(1.0)).alias("similarity")
    )
    names = firsts.select(F.col("ordinal").alias("founder"), F.col("own_story").alias("story_id"))
    out = d.join(heads, "head").join(names, "founder")
    followed = F.col("head") != F.col("ordinal")
    return out.select(
        "id",
        "ordinal",
        "story_id",
        F.when(followed, "canonical_url").when(F.col("founder") != F.col("ordinal"), "title_similarity").otherwise("founder").alias("reason"),
        F.when(followed, 1.0).otherwise(F.round("similarity", 4)).alias("similarity"),
    )


def merge_events(assigned: DataFrame) -> DataFrame:
    """The log of what was merged: story_id, item_id, merged_into, reason, similarity."""
    return assigned.where("reason <> 'founder'").select("story_id", F.col("id").alias("item_id"), F.col("story_id").alias("merged_into"), "reason", "similarity")


def score(tier_name: Column, event_at: Column, n: Column, now: dt.datetime, window_hours: float) -> dict[str, Column]:
    """Half the tier's weight, three tenths recency, two tenths heat."""
    part = {"source_tier": importance_of(tier_name), "recency": recency(event_at, now, window_hours), "story_heat": F.least(F.lit(1.0), F.greatest(F.lit(0.0), (n - 1) / 4.0))}
    total = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 * part["source_tier"] + 0.3 * part["recency"] + 0.2 * part["story_heat"]))
    return {"score": F.round(total, 4)} | {k: F.round(v, 4) for k, v in part.items()}


def records(items: DataFrame, assigned: DataFrame, now: dt.datetime, window_hours: float = 24) -> DataFrame:
    """One row a story: counts, times, names, the primary item, score, category, reasons, links.

    Counts, times and the primary item are partial aggregates; only the links are collected, which
    the output itself asks for.
    """
    d = items.join(assigned.select("id", "ordinal", "story_id"), ["id", "ordinal"])
    counts = d.groupBy("story_id").agg(F.count("*").alias("item_count"), F.min("event_at").alias("earliest_at"), F.max("event_at").alias("latest_at"))
    d = d.join(counts.select("story_id", "item_count"), "story_id").withColumn("_t", tier(F.col("site_id")))
    s = score(F.col("_t.source_tier"), F.col("event_at"), F.col("item_count"), now, window_hours)
    d = d.withColumns({f"_{k}": v for k, v in s.items()})
    shown = F.coalesce(F.nullif(F.col("title_bilingual"), F.lit("")), F.col("title")) if "title_bilingual" in items.columns else F.col("title")
    link = F.struct("id", shown.alias("title"), "url", "source", F.col("site_name").alias("source_name"), "site_id", "published_at")
    stamp = F.coalesce(F.unix_micros("event_at"), F.lit(0))
    first = F.struct(F.col("_t.source_tier_rank").alias("r"), (-F.col("_score")).alias("s"), (-stamp).alias("t"), F.coalesce("title", F.lit("")).alias("n"), F.col("ordinal").alias("o"))
    best = F.struct("id", shown.alias("title"), "url", "source", F.col("site_name").alias("source_name"), "_t", "_score", "_source_tier", "_recency", "_story_heat")
    in_order = F.struct(F.col("_t.source_tier_rank").alias("r"), (-stamp).alias("t"), F.coalesce("title", F.lit("")).alias("n"), F.col("ordinal").alias("o"), link.alias("link"))
    name = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.nullif(F.col("site_name"), F.lit("")))
    g = d.groupBy("story_id").agg(F.min_by(best, first).alias("p"), F.array_sort(F.collect_set(name)).alias("source_names"), F.transform(F.array_sort(F.collect_list(in_order)), lambda x: x["link"]).alias("items"))
    g = g.join(counts, "story_id")
    n, points = F.col("item_count"), F.col("p._score")
    official = F.col("p._t.source_tier") == "official"
    category = F.when(official, "official").when(n >= 3, "multi_source").when(points >= GATE, "industry").otherwise("watch")
    reasons = F.filter(F.array(F.when(official, "official_source"), F.when(n >= 2, "multi_source"), F.when(points >= 0.75, "high_importance")), lambda x: x.isNotNull())
    return g.select(
        "story_id", F.col("p.title").alias("title"), F.col("p.url").alias("url"), F.col("p.source").alias("source"), F.col("p.source_name").alias("source_name"),
        n.alias("source_count"), "source_names", "items", "item_count", n.alias("duplicate_count"), points.alias("score"), category.alias("category"),
        F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), category).alias("importance_label"),
        F.struct(F.col("p._source_tier").alias("source_tier"), F.col("p._recency").alias("recency"), F.col("p._story_heat").alias("story_heat")).alias("importance_breakdown"),
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("recent_ai_signal"))).alias("reasons"), "earliest_at", "latest_at",
        F.struct("p.id", "p.title", "p.url", "p.source", "p.source_name").alias("primary_item"),
    )


def in_order(stories: DataFrame) -> DataFrame:
    return stories.orderBy(F.col("score").desc(), F.col("latest_at").asc_nulls_first(), "title")


def gated(stories: DataFrame) -> DataFrame:
    """Stories of two sources or more, or with a high score."""
    return stories.where((F.coalesce(F.col("source_count").try_cast("int"), F.lit(1)) >= 2) | (F.coalesce(F.col("score").try_cast("double"), F.lit(0.0)) >= GATE))


def penalised(stories: DataFrame, limit: int = LIMIT, penalty: float = PENALTY) -> DataFrame:
    """The top by score less a penalty for each better story of the same source."""
    w = Window.partitionBy("source").orderBy(F.col("score").desc(), "title", "story_id")
    d = stories.withColumn("effective", F.round(F.col("score") - penalty * (F.row_number().over(w) - 1), 4))
    return d.orderBy(F.col("effective").desc(), F.col("score").desc(), "title", "story_id").limit(limit)


def brief(stories: DataFrame, limit: int = LIMIT, penalty: float = PENALTY) -> DataFrame:
    """rank, story_id of the brief: greedily the best score less penalties, near repeats of picked ones left out.

    The stories that are highest by their score less a penalty for each better one of the source come
    to the driver in a block of bounded size. It is gone through while no story outside of it can be
    the next; after that the executors leave out near repeats of what is picked, and another block is
    taken. A block gives one story at least, so there are at most ``limit`` blocks, of any table.
    """
    spark = stories.sparkSession
    points = F.coalesce(F.col("score").try_cast("double"), F.lit(0.0))
    d = gated(stories).select("story_id", F.coalesce("source", "source_name", F.lit("")).alias("source"), points.alias("score"), F.coalesce("title", F.lit("")).alias("title"))
    d = cut(d.withColumn("row", F.monotonically_increasing_id()), "brief")
    picked: list = []
    whole = False
    while len(picked) < limit and not whole:
        left = _compared(d).mapInPandas(_without(picked), _compared(d).schema).select(*d.columns) if picked else d
        block = _block(left, picked, penalty)
        whole = len(block) < BLOCK
        _pick(block, whole, picked, limit, penalty)
    return spark.createDataFrame([(i, s.story_id) for i, s in enumerate(picked, 1)], "rank int, story_id string")


def _compared(d: DataFrame) -> DataFrame:
    """With the columns by which near repeats are told."""
    d = d.withColumn("story_title", titles.story_title(F.col("title")))
    d = d.withColumn("words", titles.tokens(F.col("story_title")))
    return d.withColumns({"mergeable": titles.mergeable(F.col("story_title"), F.col("words")), "vendors": titles.vendors(F.col("story_title")), "models": titles.models(F.col("story_title"))})


def _block(left: DataFrame, picked: list, penalty: float) -> list:
    """The first BLOCK rows by what their score would be if all better ones of their source were picked."""
    order = [F.col("score").desc(), F.col("title"), F.col("story_id"), F.col("row")]
    known = Counter(s.source for s in picked)
    before = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col("source")), F.lit(0)) if known else F.lit(0)
    d = left.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy(*order))).where(F.col("n") <= BLOCK)
    d = d.withColumn("least", F.col("score") - penalty * (before + F.col("n") - 1))
    rows = _compared(d.orderBy(F.col("least").desc(), *order).limit(BLOCK)).collect()
    return sorted(rows, key=lambda s: (-s.least, -s.score, s.title, s.story_id, s.row))


def _pick(block: list, whole: bool, picked: list, limit: int, penalty: float) -> None:
    """Adds to ``picked`` from a block, all of the rest if ``whole``; ends early if a story outside may be the next."""
    per_source = Counter(s.source for s in picked)
    skipped: Counter[str] = Counter()
    queues: dict[str, deque] = {}
    for s in block:
        queues.setdefault(s.source, deque()).append(s)
    # A source of which all in the block are gone may have others; each that was skipped brings them a penalty nearer.
    reach = -math.inf
    while queues and len(picked) < limit:
        effective, best = min(((penalty * per_source[k] - q[0].score, q[0]) for k, q in queues.items()), key=lambda x: (x[0], -x[1].score, x[1].title, x[1].story_id, x[1].row))
        if -effective <= reach:
            return
        queues[best.source].popleft()
        if _repeated(best, picked):
            skipped[best.source] += 1
        else:
            per_source[best.source] += 1
            picked.append(best)
        if not queues[best.source]:
            del queues[best.source]
            if not whole and skipped[best.source]:
                reach = max(reach, block[-1].least + penalty * skipped[best.source] + 1e-9)


def _repeated(s, picked: list) -> bool:
    """Whether a story is a near repeat of a picked one."""
    words = set(s.words)
    return bool(s.mergeable) and any(
        words and set(o.words) and len(words & set(o.words)) >= PICK_JACCARD * len(words | set(o.words))
        and _meet(s.vendors, o.vendors) and _meet(s.models, o.models)
        and ratio(s.story_title, o.story_title, len(words & set(o.words)) / len(words | set(o.words))) >= MERGE_SIMILARITY
        for o in picked
    )


def _without(picked: list):
    """Leaves out of batches what is picked and what repeats it."""
    rows = {s.row for s in picked}

    def left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[s.row not in rows and not _repeated(s, picked) for s in b.itertuples(index=False)]]

    return left


def _meet(a, b) -> bool:
    return not len(a) or not len(b) or bool(set(a) & set(b))
