import datetime as dt
import json

from pyspark.sql import functions as F

from newsloom.operators import archive, blocks, captions
from newsloom.operators.late_events import LambdaView, daily
from newsloom.sources.files import RAW
from newsloom.sources.vtt import explode_cues
from newsloom.streaming import ingest

UTC = dt.timezone.utc
NOW = dt.datetime(2025, 11, 12, tzinfo=UTC)


def block(kind, parent, *texts):
    return {"data": {"type": kind, "parent_id": parent, "text": {"initialAttributedTexts": {"text": {str(i): t for i, t in enumerate(texts)}}}}}


PAGE = {
    "root": block("page", ""),
    "log": block("heading1", "root", "近7日", "更新日志"),
    "y": block("heading2", "root", "2025年11月"),
    "d1": block("heading3", "root", "11月10日"),
    "d2": block("heading3", "root", "11月2日"),
    "far": block("heading3", "elsewhere", "11月11日"),
    "b1": block("bullet", "d1", "《", "Big》  thing"),
    "b2": block("text", "b1", "nested"),
    "b3": block("bullet", "d1", "Big thing"),
    "b4": block("todo", "d2", "older"),
    "b5": block("bullet", "far", "not in the log"),
    "b6": block("bullet", "root", "undated"),
    "b7": block("bullet", "d1", " "),
}


def test_updates(spark):
    b = blocks.read_blocks(spark, json.dumps(PAGE))
    assert b.count() == len(PAGE)
    found = blocks.updates(b, dt.date(2025, 11, 12), "https://p")
    got = sorted((str(r.date), r.title, r.url) for r in found.collect())
    assert got == [("2025-11-02", "older", "https://p"), ("2025-11-10", "Big thing", "https://p"), ("2025-11-10", "nested", "https://p")]
    assert [r.title for r in blocks.last_week(found, dt.date(2025, 11, 12)).collect()] == ["nested", "Big thing"]
    assert tuple(blocks.digest(found).first()) == (dt.date(2025, 11, 10), 2, 3)
    assert blocks.updates(b.limit(0), dt.date(2025, 11, 12), "x").count() == 0


def test_ancestors_stop_after_so_many_hops(spark):
    nodes = spark.createDataFrame([(str(i), str(i - 1) if i else None) for i in range(40)] + [("loop", "loop")], "bid string, parent_id string")
    marked = spark.createDataFrame([("0", 7)], "bid string, mark int")
    got = {int(r.bid) for r in blocks.nearest_ancestor(nodes, marked).collect()}
    assert got == set(range(1, 21))


def vtt(*cues, settings=""):
    return "WEBVTT\n\n" + "\n\n".join(f"00:00:{i:02d}.000 --> 00:00:{i + 1:02d}.500{settings}\n{c}" for i, c in enumerate(cues))


def test_captions(spark):
    files = spark.createDataFrame(
        [(1, "a", "en", vtt(" \none two", "one two\nthree", "three\n ", settings=" align:start position:0%")), (2, "a", "de", vtt("ja", "ja")), (3, "b", "en", None), (4, None, None, "")], "vtt_id long, item_id string, lang string, vtt string"
    )
    cues = explode_cues(files)
    text = {r.vtt_id: r.text for r in captions.transcripts(captions.derolled(cues)).collect()}
    assert text == {1: "one two three", 2: "ja ja"}
    assert {r.item_id: (r.langs, r.n_files) for r in captions.coverage(files).collect()} == {"a": (["de", "en"], 2), "b": (["en"], 1), None: ([], 1)}
    assert {(r.vtt_id, r.minute): r.n_words for r in captions.speech_rate(cues).collect()} == {(1, 0): 6, (2, 0): 2}
    assert {r.vtt_id: r.n_overlaps for r in captions.overlaps(cues).collect()} == {1: 2, 2: 1}
    assert captions.derolled(cues.limit(0)).count() == 0


def test_pending(spark):
    a = spark.createDataFrame([(2, "x", "https://www.youtube.com/watch?v=1", None), (1, "y", "https://youtu.be/2", None), (3, "z", "https://youtu.be/3", " "), (4, "w", "https://a/b", None), (5, None, "https://youtu.be/3", None)], "ordinal long, id string, url string, summary string")
    have = spark.createDataFrame([("x",)], "item_id string")
    assert [r.id for r in captions.pending(a, have).collect()] == ["y"] and [r.id for r in captions.pending(a, have.limit(0), 1).collect()] == ["y"]


def test_upsert_stream_equals_batch(spark, tmp_path):
    rows = [(i, "tech", "T", "s", f"title {i % 7}", f"https://a/{i % 7}", NOW, None) for i in range(30)]
    for k in range(3):
        spark.createDataFrame(rows[k * 10 : k * 10 + 10], RAW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    table = ingest.ArchiveTable(spark, f"{tmp_path}/archive")
    ingest.upsert_stream(raw, table, f"{tmp_path}/cp", lambda n: NOW + dt.timedelta(hours=n)).awaitTermination()
    batch = archive.upsert(table.read().limit(0), archive.with_ids(spark.createDataFrame(rows, RAW)), NOW)
    assert table.version() == 2 and {r.id for r in table.read().collect()} == {r.id for r in batch.collect()}
    assert table.read().agg(F.min("first_seen_at")).first()[0].replace(tzinfo=UTC) == NOW


def test_late_stream(spark, tmp_path):
    ddl = "ordinal long, id string, published_at timestamp, first_seen_at timestamp"
    all_rows = []
    for k in range(5):
        clock = NOW + dt.timedelta(days=k)
        rows = [(10 * k + i, f"i{10 * k + i}", clock - dt.timedelta(hours=6 * i), clock) for i in range(10)]
        all_rows += rows
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    log = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    view = LambdaView(spark, f"file://{tmp_path}/view")
    ingest.late_stream(log, view, f"{tmp_path}/cp", every=2).awaitTermination()
    view.recompute(NOW + dt.timedelta(days=30))
    want = {r.period_day: r.n_items for r in daily(spark.createDataFrame(all_rows, ddl)).where("n_items > 0").collect()}
    assert {r.period_day: r.n_items for r in view.serve().where("n_items > 0").collect()} == want


def test_windowed_stream(spark, tmp_path):
    ddl = "id string, published_at timestamp"
    spark.createDataFrame([("a", NOW), ("a", NOW), ("b", NOW + dt.timedelta(hours=1))], ddl).write.parquet(f"{tmp_path}/in")
    q = ingest.counts_by_period(spark.readStream.schema(ddl).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName("periods").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("periods").agg(F.max("n")).first()[0] == 2
