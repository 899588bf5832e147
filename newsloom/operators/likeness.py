"""How many other sets of words are alike to a set, which is to share four fifths of all their words.

Sets of at most SHORT words are counted without pairs. With o words in common of n and b, they are
alike if 9 o >= 4 (n + b), so each has a fifth at most that the other lacks. A set gives its subsets
without up to a fifth of its words; the sets met at a subset are counted by size, and as two that
share more than the least overlap meet at several subsets, these are taken off again (inclusion and
exclusion). Rows grow with the sets alone, however many share their words. Subsets are told by 128
bits of hash.

Pairs with a longer set meet where they share several of their rarest words, and are then compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import titles
from newsloom.runtime import cut

#: Words of sets that are counted by subsets; up to 17, a pair's overlap is one above the least at most.
SHORT = 14
#: Words by which a pair meets, by the words of its longer set: sizes up to which, number; beyond, one.
MET = ((40, 4), (200, 2))


def alike(sets: DataFrame) -> DataFrame:
    """rep, n_links of the sets that have others alike; some that have none come with 0.

    ``sets``: rep (bigint), words (distinct), all different; it is read several times.
    """
    d = sets.withColumn("n", F.size("words"))
    found = _counted(d.where(F.col("n").between(4, SHORT)))
    if not d.where(F.col("n") > SHORT).isEmpty():
        found = found.unionByName(_paired(d.where(5 * F.col("n") >= 4 * (SHORT + 1))))
    return found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("a"), F.xxhash64(F.lit(1), w).alias("b")))


def _met(s: Column, w: Column) -> list[Column]:
    return [s["a"].bitwiseXOR(w["a"]).alias("a"), s["b"].bitwiseXOR(w["b"]).alias("b")]


def _chosen(hashes: Column, most: Column, start: Column) -> Column:
    """Each choice of up to ``most`` of the words: their number c, and a, b: the hashes of all in it met with ``start``."""
    first = F.array(F.struct(F.lit(0).alias("c"), start["a"].alias("a"), start["b"].alias("b")))
    return F.aggregate(hashes, first, lambda all_, w: F.concat(all_, F.transform(F.filter(all_, lambda s: s["c"] < most), lambda s: F.struct((s["c"] + 1).alias("c"), *_met(s, w)))))


def _none() -> Column:
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def _counted(d: DataFrame) -> DataFrame:
    h = d.select("rep", "n", _hashes(F.col("words")).alias("h"))
    h = h.withColumn("whole", F.aggregate("h", _none(), lambda s, w: F.struct(*_met(s, w))))
    keys = h.select("rep", "n", F.inline(_chosen(F.col("h"), F.floor(F.col("n") / 5), F.col("whole"))))
    here = Window.partitionBy("a", "b")
    lacking = range(SHORT // 5 + 1)
    met = keys.withColumns({f"of{e}": F.count(F.when(F.col("c") == e, 1)).over(here) for e in lacking})
    met = met.where(sum(F.col(f"of{e}") for e in lacking) > 1)
    n, j = F.col("n"), F.col("n") - F.col("c")
    links = F.lit(0).cast("long")
    for e in lacking:
        least = F.floor((4 * (n + j + e) + 8) / 9)
        times = F.when(j == least, 1).when(j == least + 1, 1 - j).otherwise(0)
        links = links + times * (F.col(f"of{e}") - F.when(F.col("c") == e, 1).otherwise(0))
    return met.select("rep", links.alias("n_links")).where("n_links <> 0")


def _words_met(n: Column) -> Column:
    (long, many), (longer, some) = MET
    return F.when(n <= long, many).when(n <= longer, some).otherwise(1)


def _paired(d: DataFrame) -> DataFrame:
    """Pairs of which the longer set is beyond SHORT."""
    each = d.select("rep", "n", F.explode("words").alias("word"))
    rare = each.groupBy("word").agg(F.count("*").alias("df"))
    ranked = each.join(rare, "word").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("r"))
    # The other set may be longer by a quarter, and the longer one tells by how many words they meet.
    several = F.array_distinct(F.array(_words_met(F.col("n")), _words_met(F.floor(F.col("n") * 5 / 4))))
    ranked = ranked.withColumn("k", F.explode(several))
    prefix = _hashes(F.transform(F.slice("r", F.lit(1), (F.floor(F.col("n") / 5) + F.col("k")).cast("int")), lambda p: p["word"]))
    keys = ranked.select("rep", "n", "k", prefix.alias("h")).select("rep", "n", "k", F.inline(_chosen(F.col("h"), F.col("k"), _none()))).where("c = k").drop("c")
    keys = keys.withColumn("met", F.count("*").over(Window.partitionBy("k", "a", "b"))).where("met > 1").drop("met")
    x = cut(keys, "met")
    y = x.select("k", "a", "b", F.col("rep").alias("o_rep"), F.col("n").alias("o_n"))
    least, most = F.least("n", "o_n"), F.greatest("n", "o_n")
    met = x.join(y, ["k", "a", "b"]).where((F.col("rep") < F.col("o_rep")) & (most > SHORT) & (5 * least >= 4 * most) & (F.col("k") == _words_met(most)))
    pairs = met.select("rep", "o_rep").distinct()
    one, other = d.select("rep", F.col("words").alias("x")), d.select(F.col("rep").alias("o_rep"), F.col("words").alias("y"))
    linked = pairs.join(one, "rep").join(other, "o_rep").where(titles.jaccard(F.col("x"), F.col("y")) >= 0.8)
    return linked.select(F.explode(F.array("rep", "o_rep")).alias("rep"), F.lit(1).cast("long").alias("n_links"))
