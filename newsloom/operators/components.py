"""Connected components of a link table by alternating stars.

Each step is a partial minimum and an equi-join, so a node with very many links is pre-aggregated
before the shuffle and its join partition is split by the adaptive skew join. The rounds grow with
the logarithm of the longest chain; each is cut off as a table in the shared folder. Link tables
whose counted size is within LOCAL_LINKS are done by one task in one step, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.runtime import cut


#: Links up to which one task finds the components: 16 bytes each, and a few times that while it works.
LOCAL_LINKS = 250_000


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components by union of sets; the smaller root holds."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist(), strict=True):
            a, z = root(u), root(v)
            if a != z:
                up[max(a, z)] = min(a, z)
    nodes = list(up)
    yield pd.DataFrame({"u": pd.Series(nodes, dtype="int64"), "root": pd.Series([root(x) for x in nodes], dtype="int64")})


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(least, "u")
    return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """u, root: every node that is not the smallest of its component, with that smallest node.

    ``links``: u, v (bigint), in any direction, repeated or not; null ends and loops are dropped.
    """
    e = links.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = cut(e, "cc")
    if e.count() <= LOCAL_LINKS:
        return cut(e.repartition(1).mapInPandas(_local, "u long, root long"), "cc")
    # Components are stars once no root hangs below another node and every node below has one root.
    while not e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty() or not e.groupBy("u").count().where("count > 1").isEmpty():
        e = cut(_small(_large(e)), "cc")
    return e.select("u", F.col("v").alias("root"))
