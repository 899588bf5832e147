"""Alike sets of words against all pairs compared, and what the count writes."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import likeness
from newsloom.plans import reference


def brute(sets):
    out = {}
    for i, x in sets.items():
        n = sum(5 * len(x & y) >= 4 * len(x | y) for k, y in sets.items() if k != i)
        if n:
            out[i] = n
    return out


def made(seed, sizes, count):
    """Sets of each size, many of them another with words left out, put in or changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    found = []
    for _ in range(count):
        s = set(rng.sample(words, rng.choice(sizes)))
        if found and rng.random() < 0.8:
            s = set(rng.choice(found))
            for _ in range(rng.randrange(1, 1 + max(1, len(s) // 8))):
                if rng.random() < 0.6 and s:
                    s.remove(rng.choice(sorted(s)))
                if rng.random() < 0.6:
                    s.add(rng.choice(words))
        if s and s not in found:
            found.append(s)
    return dict(enumerate(found))


def counted(spark, sets):
    df = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "rep long, words array<string>").repartition(3)
    return {r.rep: r.n_links for r in likeness.alike(df).collect() if r.n_links}


@pytest.mark.parametrize("sizes", [range(1, 10), range(8, 15), range(11, 24), [34, 38, 41, 45, 50], [12, 190, 205, 230]])
def test_alike(spark, sizes):
    sets = made(len(sizes), list(sizes), 250)
    want = brute(sets)
    assert counted(spark, sets) == want and len(want) > 50


def test_alike_over_one_place(spark):
    """All pairs of a template are alike; they are counted without being made."""
    sets = {i: {f"t{k}" for k in range(8)} | {f"x{i}"} for i in range(300)}
    sets[300] = {f"t{k}" for k in range(8)}
    assert counted(spark, sets) == {i: 300 for i in range(301)}


def test_alike_of_nothing(spark):
    assert counted(spark, {0: {"a", "b", "c", "d"}}) == {}
    assert likeness.alike(spark.createDataFrame([], "rep long, words array<string>")).count() == 0


def test_links_of_titles_of_few_words_write_little(spark, tmp_path):
    """Titles of which every pair shares words: what is written grows with the titles, not with their pairs."""
    n = 12_000
    words = [F.concat(F.lit("abcdef"[k]), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(8))) for k in range(6)]
    spark.range(n).select(F.col("id").alias("ordinal"), F.concat_ws(" ", *words).alias("title")).write.parquet(f"{tmp_path}/archive_item.parquet")

    def written():
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorList(False).apply(0).totalShuffleWrite()

    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else small tables are not shuffled
    try:
        before = written()
        assert len(reference.title_jaccard_links(spark, str(tmp_path)).collect()) == n
        assert written() - before < 10_000_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
