"""Files of state: subscriptions, archive, title cache, captions on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.sources.feeds import opml

ARCHIVE = (
    "id string, site_id string, site_name string, source string, title string, url string, published_at timestamp, first_seen_at timestamp, "
    "last_seen_at timestamp, star boolean, thumbnail string, summary string, ordinal bigint"
)
RAW = "ordinal bigint, site_id string, site_name string, source string, title string, url string, published_at timestamp, meta map<string,string>"
_ITEM = ARCHIVE.removesuffix(", ordinal bigint")


def read_opml(spark: SparkSession, path: str) -> DataFrame:
    """title, category, xml_url, html_url, ordinal. A subscription list is one small file."""
    text = spark.read.text(path, wholetext=True).first()
    return spark.createDataFrame(opml(text[0]) if text else [], "title string, category string, xml_url string, html_url string, ordinal int")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The items of archive JSON, a list or a map by id; the last of equal ids; a missing or broken file is empty."""
    try:
        raw = spark.read.text(path, wholetext=True).select("value")
        raw.limit(1).collect()
    except Exception:  # noqa: BLE001  no file yet
        raw = spark.createDataFrame([], "value string")
    listed = raw.select(F.posexplode(F.from_json("value", f"items array<struct<{_as_struct(_ITEM)}>>")["items"]).alias("ordinal", "r"))
    mapped = raw.select(F.explode(F.from_json("value", f"items map<string,struct<{_as_struct(_ITEM)}>>")["items"]).alias("key", "r")).select(
        F.monotonically_increasing_id().cast("int").alias("ordinal"), F.col("r").withField("id", F.coalesce("r.id", "key")).alias("r")
    )
    rows = listed.unionByName(mapped).select("r.*", F.col("ordinal").cast("bigint").alias("ordinal")).where("id is not null and id <> ''")
    return rows.groupBy("id").agg(F.max_by(F.struct(*rows.columns), "ordinal").alias("r")).select("r.*")


def _as_struct(ddl: str) -> str:
    return ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in ddl.split(", "))


def read_title_cache(spark: SparkSession, path: str) -> DataFrame:
    """title, title_zh of a JSON object; blank keys and values are dropped."""
    raw = spark.read.text(path, wholetext=True)
    pairs = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("title", "title_zh"))
    return pairs.where("trim(title) <> '' and trim(title_zh) <> ''")


def captioned(spark: SparkSession, path: str) -> DataFrame:
    """item_id of every caption file under ``path``: what is there already."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.vtt").load(path)
    return files.select(F.regexp_extract(name, r"^([^.]+)\.", 1).alias("item_id")).distinct()
