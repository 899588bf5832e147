"""Copies that differ in formatting alone (problem 7).

Records get a canonical key, are range-partitioned and sorted by it (Spark's sort spills to disk,
so a partition may exceed memory), and one scan of each sorted partition compares the full keys of
neighbours. The ordinal is part of the range, so that a key that holds a third of all rows is laid
over as many partitions as its share; its pieces are stitched by a table with one row a partition.

Defined results: a null or blank title or url takes a row out; a title without letter or digit
agrees with every other such title; of equal ordinals one row each is kept as it comes; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import is_blank, letters, strip
from newsloom.functions.urls import spelling_key
from newsloom.runtime import cut

_SCAN = (
    "part int, edge boolean, head boolean, ordinal long, first_ordinal long, "
    "first_title string, first_url string, last_title string, last_url string, tail_first long, whole boolean"
)


def title_key(title: Column) -> Column:
    """Letters and digits in order, case aside; the parts around ``|`` in the order that sorts first."""
    parts = F.transform(F.split(title, r"\|"), letters)
    return F.when(~title.contains("|"), letters(title)).otherwise(F.array_join(
        F.array_sort(parts, lambda a, b: F.when(F.concat(a, b) < F.concat(b, a), -1).when(F.concat(a, b) > F.concat(b, a), 1).otherwise(0)), ""
    ))


def canonical(items: DataFrame) -> DataFrame:
    """ordinal, title_key, url_key of the rows that can be compared."""
    rows = items.where(~is_blank(F.col("title"))).select(F.col("ordinal").cast("long").alias("ordinal"), "title", strip(F.col("url")).alias("u"))
    return rows.where("u <> ''").select("ordinal", title_key(F.col("title")).alias("title_key"), spelling_key(F.col("u")).alias("url_key"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys in one sorted partition: a row for each record, one edge row at the end."""
    schema = pa.schema(
        [("part", pa.int32()), ("edge", pa.bool_()), ("head", pa.bool_()), ("ordinal", pa.int64()), ("first_ordinal", pa.int64())]
        + [(n, pa.string()) for n in ("first_title", "first_url", "last_title", "last_url")]
        + [("tail_first", pa.int64()), ("whole", pa.bool_())]
    )
    part = TaskContext.get().partitionId()
    opening = last = None
    first, head = 0, True
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        t, u, ordinal = b["title_key"], b["url_key"], b["ordinal"].to_numpy()
        new = np.ones(n, bool)
        if n > 1:
            same = pc.and_(pc.equal(t.slice(1), t.slice(0, n - 1)), pc.equal(u.slice(1), u.slice(0, n - 1)))
            new[1:] = ~same.to_numpy(zero_copy_only=False)
        key = (t[0].as_py(), u[0].as_py())
        if last is None:
            opening = key
        else:
            new[0] = key != last
        at = np.where(new, np.arange(n), -1)
        at = np.maximum.accumulate(at)
        firsts = np.where(at >= 0, ordinal[np.maximum(at, 0)], first)
        started = new.copy()
        started[0] = new[0] and last is not None
        heads = ~np.logical_or.accumulate(started) & head
        head = bool(heads[-1])
        first, last = int(firsts[-1]), (t[n - 1].as_py(), u[n - 1].as_py())
        none = pa.nulls(n, pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, bool)), pa.array(heads), pa.array(ordinal), pa.array(firsts), none, none, none, none, pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())],
            schema=schema,
        )
    if last is not None:
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "edge": True, "head": False, "first_title": opening[0], "first_url": opening[1], "last_title": last[0], "last_url": last[1], "tail_first": first, "whole": head}],
            schema=schema,
        )


def grouped(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """first_ordinal, ordinal: every comparable row with the smallest ordinal of its group."""
    keyed = cut(canonical(items), "p7-keys")  # read twice: for the bounds of the ranges, and to be sorted
    n = partitions or int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["title_key", "url_key", "ordinal"]
    scanned = cut(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_scan, _SCAN), "p7-scan")
    edges = scanned.where("edge")
    # One row a partition: the run that opens a partition goes on from the last run of the one before.
    by_part = Window.orderBy("part")
    edges = edges.select(
        "part",
        "whole",
        "tail_first",
        F.coalesce((F.lag("last_title").over(by_part) == F.col("first_title")) & (F.lag("last_url").over(by_part) == F.col("first_url")), F.lit(False)).alias("linked"),
    ).select(
        "part",
        "linked",
        F.last(F.when(F.col("whole") & F.col("linked"), None).otherwise(F.col("tail_first")), ignorenulls=True)
        .over(by_part.rowsBetween(Window.unboundedPreceding, -1))
        .alias("carried"),
    )
    return (
        scanned.where("not edge")
        .join(F.broadcast(edges.where("linked")), "part", "left")
        .select(F.when(F.col("head") & F.col("carried").isNotNull(), F.col("carried")).otherwise(F.col("first_ordinal")).alias("first_ordinal"), "ordinal")
    )


def copies(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """first_ordinal, copy_ordinal: each copy with the smallest ordinal of its group."""
    return grouped(items, partitions).where("ordinal <> first_ordinal").select("first_ordinal", F.col("ordinal").alias("copy_ordinal"))


def records(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """first_ordinal, n_copies: one row for each record with the number of rows that spell it."""
    return grouped(items, partitions).groupBy("first_ordinal").agg(F.count("*").alias("n_copies"))
