"""Streams of raw items: archive upserts and event-time views per micro-batch, late data with watermarks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators import archive as ops
from newsloom.operators.late_events import LambdaView
from newsloom.runtime import remove
from newsloom.sources.files import ARCHIVE


class ArchiveTable:
    """The archive as numbered versions under a path; a version that is complete has its number in ``current``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = fs.Path
        self._fs = fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The last complete version, or -1: a version is complete when its _SUCCESS file is there."""
        root = self._path(self.path)
        if not self._fs.exists(root):
            return -1
        done = [int(s.getPath().getName()[1:]) for s in self._fs.listStatus(root) if s.getPath().getName().startswith("v") and self._fs.exists(self._path(s.getPath(), "_SUCCESS"))]
        return max(done, default=-1)

    def read(self) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(ARCHIVE).parquet(f"{self.path}/v{v}") if v >= 0 else self.spark.createDataFrame([], ARCHIVE)

    def write(self, df: DataFrame, version: int, keep: int = 2) -> None:
        df.select(*[c.split()[0] for c in ARCHIVE.split(", ")]).write.mode("overwrite").parquet(f"{self.path}/v{version}")
        for old in range(max(0, version - keep - 3), version - keep + 1):
            remove(self.spark, f"{self.path}/v{old}")


def upsert_stream(raw: DataFrame, table: ArchiveTable, checkpoint: str, clock: Callable[[int], dt.datetime], days: int = ops.ARCHIVE_DAYS, once: bool = True) -> StreamingQuery:
    """Each micro-batch is upserted into the archive and the archive pruned.

    A batch that is run again after a failure writes the same version again, from the version before.
    """

    def step(batch: DataFrame, number: int) -> None:
        now = clock(number)
        if table.version() >= number:
            return
        merged = ops.upsert(table.read(), ops.with_ids(ops.ingestible(batch)), now)
        table.write(ops.retained(merged, now, days), number)

    writer = raw.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def late_stream(log: DataFrame, view: LambdaView, checkpoint: str, every: int = 4, once: bool = True) -> StreamingQuery:
    """Each micro-batch goes to the fast layer; every few the batch layer recomputes, by the batch's own latest clock.

    The run has the micro-batch's number, so one that is run again after a failure is taken in once.
    """

    def step(batch: DataFrame, number: int) -> None:
        clock = batch.agg(F.max("first_seen_at")).first()[0]
        if clock is None:
            return
        view.ingest(batch, number)
        if number % every == every - 1:
            view.recompute(clock.replace(tzinfo=dt.timezone.utc))

    writer = log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def counts_by_period(events: DataFrame, period: str = "1 day", lateness: str = "48 hours") -> DataFrame:
    """period_start, n of a stream by event time: each id once, updated until the watermark passes the lateness."""
    once = events.withWatermark("published_at", lateness).dropDuplicatesWithinWatermark(["id"])
    return once.groupBy(F.window("published_at", period).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("period_start"), "n")
