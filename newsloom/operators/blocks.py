"""Dated updates in a tree of page blocks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import squeeze
from newsloom.functions.times import date_near, month_day, year_month

HOPS = 20
_TEXT = "map<string,struct<data:struct<type:string,parent_id:string,text:struct<initialAttributedTexts:struct<text:map<string,string>>>>>>"


def block_text(pieces: Column) -> Column:
    """The pieces of a block's text in order of their number."""
    numbered = F.transform(F.map_entries(pieces), lambda e: F.struct(F.coalesce(e["key"].try_cast("int"), F.lit(0)).alias("k"), e["value"].alias("v")))
    return F.coalesce(F.array_join(F.transform(F.array_sort(numbered), lambda e: e["v"]), ""), F.lit(""))


def read_blocks(spark: SparkSession, text: str) -> DataFrame:
    """ordinal, bid, parent_id, type, text of a block map in JSON."""
    raw = spark.createDataFrame([(text,)], "value string").select(F.posexplode(F.map_entries(F.from_json("value", _TEXT))).alias("ordinal", "e"))
    data = F.col("e.value.data")
    return raw.select("ordinal", F.col("e.key").alias("bid"), data["parent_id"].alias("parent_id"), data["type"].alias("type"), block_text(data["text"]["initialAttributedTexts"]["text"]).alias("text"))


def clean_title(text: Column) -> Column:
    return squeeze(F.regexp_replace(text, "《\\s*》|《|》", ""))


def nearest_ancestor(nodes: DataFrame, marked: DataFrame, hops: int = HOPS) -> DataFrame:
    """bid, mark of the nearest ancestor among ``marked`` (bid, mark), at most so many steps up.

    Pointer doubling: after k joins every block knows its nearest mark within 2^k steps.
    """
    step = nodes.select("bid", F.col("parent_id").alias("to")).join(marked.select(F.col("bid").alias("to"), "mark"), "to", "left").select("bid", "to", "mark", F.when(F.col("mark").isNotNull(), 1).alias("at"))
    reach = 1
    while reach < hops:
        up = step.select(F.col("bid").alias("to"), F.col("to").alias("further"), F.col("mark").alias("above"), F.col("at").alias("above_at"))
        step = step.join(up, "to", "left").select(
            "bid", F.when(F.col("mark").isNull(), F.col("further")).alias("to"), F.coalesce("mark", "above").alias("mark"), F.coalesce(F.col("at"), F.col("above_at") + reach).alias("at")
        )
        reach *= 2
    return step.where(F.col("mark").isNotNull() & (F.col("at") <= hops)).select("bid", "mark")


def updates(blocks: DataFrame, today: dt.date, page_url: str) -> DataFrame:
    """date, title, url of the entries below dated headings; each (date, title) once, in the page's order."""
    heading = F.col("type").isin("heading1", "heading2", "heading3")
    recent = blocks.where(heading & (F.col("text").contains("近7日更新日志") | F.col("text").contains("近 7 日更新日志"))).where("parent_id <> ''").select(F.col("parent_id").alias("log")).distinct()
    dated = blocks.where("type = 'heading3'").withColumn("md", month_day(F.col("text"))).where("md is not null")
    has_log = bool(recent.limit(1).count())
    if has_log:
        dated = dated.join(recent, dated["parent_id"] == recent["log"], "left_semi")
    years = blocks.where("type = 'heading2'").select(F.col("bid").alias("parent_id"), year_month(F.col("text")).alias("ym")).where("ym is not null")
    dated = dated.join(years, "parent_id", "left")
    own = F.to_date(F.try_to_timestamp(F.concat_ws("-", F.coalesce("ym.year", F.lit(today.year)), "md.month", "md.day"), F.lit("yyyy-M-d")))
    marks = dated.select("bid", F.coalesce(date_near(F.col("md.month"), F.col("md.day"), today), own).alias("mark")).where("mark is not null")
    entries = blocks.where(F.col("type").isin("bullet", "text", "todo", "ordered")).select("bid", "ordinal", clean_title(F.col("text")).alias("title")).where("title <> ''")
    found = entries.join(nearest_ancestor(blocks, marks), "bid")
    once = found.groupBy(F.col("mark").alias("date"), "title").agg(F.min("ordinal").alias("ordinal"))
    return once.select("date", "title", F.lit(page_url).alias("url"), "ordinal")


def last_week(found: DataFrame, today: dt.date) -> DataFrame:
    """The updates of the last seven days, the latest first."""
    return found.where(F.col("date").between(F.lit(today - dt.timedelta(days=6)), F.lit(today))).orderBy(F.col("date").desc(), F.col("title").desc())


def digest(found: DataFrame) -> DataFrame:
    """latest_date, n_latest, n_all."""
    by_date = found.groupBy("date").agg(F.count("*").alias("n"))
    return by_date.agg(F.max("date").alias("latest_date"), F.max_by("n", "date").alias("n_latest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"))
