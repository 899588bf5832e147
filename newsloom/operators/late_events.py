"""Counts by event time, corrected as late records arrive (problem 2).

A lambda view: a fast layer adds each batch's rows to provisional periods; a scheduled batch layer
recomputes the open periods from the whole log, replaces them, and freezes those past the cut-off.

Defined results: rows without id or published_at are not counted; a row without first_seen_at
counts as on time; an id counts once, by its first row (smallest ordinal) with a published_at.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.runtime import names, remove, small_side

CUTOFF_HOURS = 48
#: Batches in which a whole log is taken in, and after how many the batch layer runs.
BATCHES, EVERY = 8, 2
_DAY = 86_400_000_000
_LOG = "ordinal long, id string, published_at timestamp, first_seen_at timestamp"


def _end_micros(day: Column) -> Column:
    return (F.unix_date(day).cast("long") + 1) * F.lit(_DAY)


def sightings(log: DataFrame) -> DataFrame:
    """ordinal, published_at, first_seen_at, period: the row by which each id counts.

    Partial minima are taken before the shuffle, so an id with very many rows costs one row a task.
    """
    first = (
        log.where(F.col("id").isNotNull() & F.col("published_at").isNotNull())
        .groupBy("id")
        .agg(F.min(F.struct("ordinal", "published_at", "first_seen_at")).alias("r"))
    )
    return first.select("id", "r.*").withColumn("period", F.to_date(F.col("published_at")))


def verdict(cutoff_hours: int = CUTOFF_HOURS) -> Column:
    """on_time before the end of the period, corrects up to the cut-off, too_late after it."""
    late = F.unix_micros(F.col("first_seen_at").cast("timestamp")) - _end_micros(F.col("period"))
    return F.when(late.isNull() | (late < 0), "on_time").when(late <= cutoff_hours * 3_600_000_000, "corrects").otherwise("too_late")


def classified(log: DataFrame, cutoff_hours: int = CUTOFF_HOURS) -> DataFrame:
    """ordinal, id, period_day, verdict of each counted row."""
    return sightings(log).select("ordinal", "id", F.date_format("period", "yyyy-MM-dd").alias("period_day"), verdict(cutoff_hours).alias("verdict"))


def late_rows(log: DataFrame, cutoff_hours: int = CUTOFF_HOURS) -> DataFrame:
    """ordinal, period_day, verdict of the rows that came after the end of their period."""
    return classified(log, cutoff_hours).where("verdict <> 'on_time'").select("ordinal", "period_day", "verdict")


def daily(log: DataFrame, cutoff_hours: int = CUTOFF_HOURS) -> DataFrame:
    """period_day, n_on_time, n_corrects, n_too_late, n_items: the counts as they stand at the end."""
    return counts(classified(log, cutoff_hours))


def counts(rows: DataFrame) -> DataFrame:
    """Counts by period of classified rows."""
    return (
        rows.groupBy("period_day")
        .agg(*[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("on_time", "corrects", "too_late")])
        .withColumn("n_items", F.col("n_on_time") + F.col("n_corrects"))
    )


class LambdaView:
    """Period counts kept under ``path`` in the shared folder.

    log/         every row ever taken in, by run
    fast/        increments of the runs since the last recompute
    rows-N-R/    ordinal, period_day, verdict of each row that recompute N counted, over the runs before R
    view-N-R/    the counts of rows-N-R; the complete folder with the largest N holds
    A run is in once its increments are complete, a recompute once its view is; the view's name says
    which runs it covers. So a stop at any point leaves the state before or after, and nothing counts
    twice: increments that a view covers are never served, whether they are still there or not.
    """

    def __init__(self, spark: SparkSession, path: str, cutoff_hours: int = CUTOFF_HOURS):
        self.spark, self.path, self.cutoff_hours = spark, path.rstrip("/"), cutoff_hours
        whole = [tuple(map(int, n.split("-")[1:])) for n in names(spark, self.path) if n.startswith("view-") and self._complete(n)]
        #: Number of the view in force (0: none), and the first run that it doesn't cover.
        self.views, self.covered = max(whole, default=(0, 0))
        self.since = sorted(r for n in names(spark, f"{self.path}/fast") if n.startswith("run=") and (r := int(n[4:])) >= self.covered and self._complete(f"fast/{n}"))
        self.runs = max([self.covered, *(r + 1 for r in self.since)])

    def _complete(self, part: str) -> bool:
        return "_SUCCESS" in names(self.spark, f"{self.path}/{part}")

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}")

    def _log(self) -> DataFrame:
        """The rows of all runs that are in; those of a run that was broken off are not."""
        return self.spark.read.schema(_LOG).parquet(*[f"{self.path}/log/run={r}" for r in range(self.runs) if r < self.covered or r in self.since])

    @property
    def _now(self) -> str:
        return f"{self.views}-{self.covered}"

    def ingest(self, batch: DataFrame, number: int | None = None) -> int:
        """Fast layer: appends the batch to the log and its counts to the provisional periods.

        It sees this batch alone, so an id that was counted in an earlier run is counted again
        until the next recompute; a row past the cut-off is logged but raises no count. A batch with
        a number that is in already is left alone; numbers ascend without gaps or with.
        """
        run = self.runs if number is None else number
        if run < self.covered or run in self.since:
            return run
        batch.select("ordinal", "id", "published_at", "first_seen_at").write.mode("overwrite").parquet(f"{self.path}/log/run={run}")
        mine = self.spark.read.schema(_LOG).parquet(f"{self.path}/log/run={run}")
        counted = classified(mine, self.cutoff_hours).where("verdict <> 'too_late'")
        counted.groupBy("period_day").agg(F.count("*").alias("n_items")).write.mode("overwrite").parquet(f"{self.path}/fast/run={run}")
        self.since = sorted({*self.since, run})
        self.runs = max(self.runs, run + 1)
        return run

    def recompute(self, clock) -> DataFrame:
        """Batch layer: open periods anew from the whole log; periods whose cut-off is before ``clock``
        (a datetime in UTC) are frozen as they then stand. A row that arrives at the very cut-off still
        corrects, so a period whose cut-off is at ``clock`` is frozen only if the run of ``clock`` is in."""
        log = self._log()
        now = F.lit(clock).cast("timestamp")
        run_is_in = not log.where(F.col("first_seen_at").cast("timestamp") == now).isEmpty()
        cutoff = _end_micros(F.to_date("period_day")) + self.cutoff_hours * 3_600_000_000
        rows = classified(log, self.cutoff_hours).select("ordinal", "period_day", "verdict")
        if self.views:
            # Of a frozen period the rows stand as they were; what came since is too late.
            frozen = small_side(self._read(f"view-{self._now}").where("frozen").select("period_day"))
            held = self._read(f"rows-{self._now}").where("verdict <> 'too_late'").join(frozen, "period_day", "left_semi")
            since = rows.join(frozen.withColumn("is_frozen", F.lit(True)), "period_day", "left").where("is_frozen is null or verdict = 'too_late'")
            rows = held.unionByName(since.drop("is_frozen"))
        before, new = self._now, f"{self.views + 1}-{self.runs}"
        rows.write.mode("overwrite").parquet(f"{self.path}/rows-{new}")
        fresh = counts(self._read(f"rows-{new}")).withColumn("frozen", F.unix_micros(now) >= cutoff if run_is_in else F.unix_micros(now) > cutoff)
        fresh.write.mode("overwrite").parquet(f"{self.path}/view-{new}")
        # From here on the new view holds; what is removed is read no more.
        done, self.since, self.views, self.covered = self.since, [], self.views + 1, self.runs
        for run in done:
            remove(self.spark, f"{self.path}/fast/run={run}")
        for part in ("view", "rows"):
            remove(self.spark, f"{self.path}/{part}-{before}")
        return self._read(f"view-{self._now}")

    def late(self) -> DataFrame:
        """ordinal, period_day, verdict of the rows that came after the end of their period, as of the last recompute."""
        return self._read(f"rows-{self._now}").where("verdict <> 'on_time'").select("ordinal", "period_day", "verdict")

    def daily(self) -> DataFrame:
        """period_day, n_on_time, n_corrects, n_too_late, n_items as of the last recompute."""
        return self._read(f"view-{self._now}").drop("frozen")

    def serve(self) -> DataFrame:
        """period_day, n_items, state: frozen, corrected by the last recompute, or provisional."""
        schema = "period_day string, n_items long, frozen boolean"
        view = self._read(f"view-{self._now}") if self.views else self.spark.createDataFrame([], schema)
        fast = self.spark.createDataFrame([], "period_day string, n_items long")
        for run in self.since:
            fast = fast.unionByName(self._read(f"fast/run={run}"))
        fast = fast.groupBy("period_day").agg(F.sum("n_items").alias("more"))
        frozen = F.coalesce(F.col("frozen"), F.lit(False))
        return view.join(fast, "period_day", "full_outer").select(
            "period_day",
            (F.coalesce("n_items", F.lit(0)) + F.when(frozen, 0).otherwise(F.coalesce("more", F.lit(0)))).cast("long").alias("n_items"),
            F.when(frozen, "frozen").when(F.col("more").isNotNull(), "provisional").otherwise("corrected").alias("state"),
        )


def replay(log: DataFrame, path: str, batches: int = BATCHES, every: int = EVERY) -> LambdaView:
    """Takes in a whole log in so many batches of whole runs, in order of their clocks, and recomputes
    after every few of them and at the end. Rows without first_seen_at are in the first batch.
    Ordinals ascend with the clocks: that an id counts by its smallest is known when its period is frozen."""
    at = F.col("first_seen_at")
    clocks = [r[0] for r in log.select(at).where(at.isNotNull()).distinct().orderBy(at).collect()]  # one row a run
    view = LambdaView(log.sparkSession, path)
    ends = sorted({clocks[len(clocks) * i // batches - 1] for i in range(1, batches + 1) if len(clocks) * i >= batches})
    if not ends:
        view.ingest(log)
        view.recompute(dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc))
    for i, end in enumerate(ends):
        view.ingest(log.where((at > F.lit(ends[i - 1])) & (at <= F.lit(end)) if i else at.isNull() | (at <= F.lit(end))))
        if (i + 1) % every == 0 or i + 1 == len(ends):
            view.recompute(end)
    return view
