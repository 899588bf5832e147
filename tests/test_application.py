"""The two programs from end to end, with a made-up network."""

import datetime as dt
import json

from newsloom.plans import application as A

NOW = dt.datetime(2025, 11, 5, 12, tzinfo=dt.timezone.utc)
OPML = """<opml version="2.0"><body><outline text="all">
<outline title="Feed A" category="tech" xmlUrl="https://a.example/rss" htmlUrl=""/><outline title="Gone" category="" xmlUrl="https://gone.example/rss" htmlUrl=""/>
</outline></body></opml>"""
RSS = """<rss><channel><item><title>Two libraries open on the river bank today</title><link>https://www.youtube.com/watch?v=abcdef1</link><pubDate>Wed, 05 Nov 2025 10:00:00 GMT</pubDate></item>
<item><title>A quiet mail to someone@example.com</title><link>https://a.example/2</link><pubDate>Wed, 05 Nov 2025 09:00:00 GMT</pubDate></item></channel></rss>"""


def fetch(url):
    return {"https://a.example/rss": RSS}[url]


def lines(folder):
    return [json.loads(x) for p in sorted(folder.glob("*.json")) for x in p.read_text().splitlines()]


def test_update_and_captions(spark, tmp_path, capsys):
    (tmp_path / "subs.opml").write_text(OPML)
    out = tmp_path / "out"
    asked = []
    names = A.update(spark, f"file://{out}", NOW, fetch, f"file://{tmp_path}/subs.opml", translate=lambda t: asked.append(t) or (None if "mail" in t else "译文"), translate_max_new=5)
    assert {"archive", "latest-items", "daily-brief", "stories-merged", "source-status", "feed-status", "status-summary", "title-cache"} <= set(names)
    archive = lines(out / "archive")
    assert len(archive) == 2 and {r["site_id"] for r in archive} == {"tech"} and "[redacted-email]" in json.dumps(archive)
    assert sorted((r["feed_title"], r["ok"], r["n_items"]) for r in lines(out / "feed-status")) == [("Feed A", True, 2), ("Gone", False, 0)]
    assert lines(out / "status-summary")[0]["n_sites"] == 1 and lines(out / "source-status")[0]["error"] == "1 feeds failed"
    assert lines(out / "title-cache") == [{"title": "Two libraries open on the river bank today", "title_zh": "译文"}] and len(asked) == 2
    assert lines(out / "week-digest")[0]["ok"] is False

    # A day later without sources: nothing is new, the archive stays, the window is empty.
    A.main(["update", "--output-dir", f"file://{out}", "--now", "2025-11-07T12:00:00+00:00", "--rss-opml", f"file://{tmp_path}/none.opml"], spark=spark)
    assert len(lines(out / "archive")) == 2 and lines(out / "latest-items") == [] and "OPML not found" in lines(out / "source-status")[0]["error"]
    before = {r["id"]: r["first_seen_at"] for r in archive}
    assert {r["id"]: r["first_seen_at"] for r in lines(out / "archive")} == before

    said = []
    A.main(["captions", "--output-dir", f"file://{out}", "--captions-dir", f"file://{tmp_path}/vtt"], download=lambda i, url: said.append(url) or "none", spark=spark)
    assert said == ["https://www.youtube.com/watch?v=abcdef1"] and "none=1" in capsys.readouterr().out
    A.main(["captions", "--output-dir", f"file://{out}", "--captions-dir", f"file://{tmp_path}/vtt"], download=lambda i, url: said.append(url) or "done", spark=spark)
    assert len(said) == 1  # marked, and not asked for again


def test_translations_are_counted_by_success(spark):
    from newsloom.plans.pipeline import translated

    rows = [(k, f"An English headline number {k}", f"https://a.example/{k}", NOW - dt.timedelta(minutes=k)) for k in range(8)]
    shown = spark.createDataFrame(rows, "ordinal long, title string, url string, event_at timestamp")
    cache = spark.createDataFrame([("An English headline number 1", "标题一")], "title string, title_zh string")
    asked = []
    got = translated(shown, cache, lambda t: asked.append(t) or ("译" + t if int(t[-1]) % 2 == 0 else "no Han"), 2)
    assert asked == [f"An English headline number {k}" for k in (0, 2)] and got.count() == 3
