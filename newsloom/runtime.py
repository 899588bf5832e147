"""Session, tables and shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def local_session(app: str = "newsloom", cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and local runs; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NEWSLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local (tests on one machine) a temporary folder is
    made and set; a cluster without it is an error, since no folder of one machine is shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known:
        return known.rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="newsloom-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rsplit("/", 1)[0]


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/newsloom/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    The lineage ends there, and the table outlives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file(spark, path)
    fs.delete(at, True)


def _file(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file(spark, path)
    return fs.exists(at)


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, at = _file(spark, path)
    _, there = _file(spark, to)
    if not fs.rename(at, there):
        raise OSError(f"could not move {path} to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the shared storage; none if there is no such folder."""
    fs, at = _file(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or null if there is none."""
    fs, at = _file(spark, path)
    if not fs.exists(at):
        return None
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def write_state(spark: SparkSession, path: str, text: str, number: int) -> None:
    """Puts a small numbered file ``path-N`` beside the older ones, whole or not at all; all but the one before it are removed.

    Nothing is deleted before the new file is in place, so there is always a complete one.
    """
    folder, _, name = path.rpartition("/")
    fs, new = _file(spark, f"{folder}/.{name}-{number}.new")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, at = _file(spark, f"{path}-{number}")
    if fs.exists(at):  # the same step done again
        fs.delete(at, False)
    if not fs.rename(new, at):
        raise OSError(f"could not move {path}-{number}.new")
    for old in _numbers(spark, path):
        if old < number - 1:
            remove(spark, f"{path}-{old}")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, _, name = path.rpartition("/")
    return [int(n.removeprefix(f"{name}-")) for n in names(spark, folder) if n.startswith(f"{name}-") and n.removeprefix(f"{name}-").isdigit()]


def read_state(spark: SparkSession, path: str) -> str | None:
    """The text of the largest of the files ``path-N``, or null if there is none."""
    known = _numbers(spark, path)
    return read_text(spark, f"{path}-{max(known)}") if known else None


def ranked(ordered: DataFrame, name: str = "place") -> DataFrame:
    """``ordered`` with the place of each row, from 1, written once: by partitions in order, never in one task."""
    at = F.col("_at")
    d = cut(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(at, 33)
    sizes = d.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # one row a partition
    return d.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + at.bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


#: Rows up to which a side table may be broadcast; beyond it the join stays a shuffled one.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is proven to have at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def setting(spark: SparkSession, name: str, default: bool | int | float | str) -> bool | int | float | str:
    """``newsloom.<name>`` of the session's configuration as the kind that ``default`` is; the default if unset or unreadable."""
    raw = spark.conf.get(f"newsloom.{name}", None)
    if raw is None or not raw.strip():
        return default
    if isinstance(default, bool):
        return raw.strip().lower() in ("1", "true", "yes", "on")
    try:
        return type(default)(raw.strip())
    except ValueError:
        return default


def sweep(spark: SparkSession) -> None:
    """Removes all scratch tables of this library in the shared folder; no frame built on them may be read afterwards."""
    remove(spark, f"{shared_root(spark)}/newsloom")
