"""Parsers on small documents written by hand."""

import datetime as dt
import json

from newsloom.sources import feeds as S
from newsloom.sources import files, vtt
from newsloom.sources.html import tree

UTC = dt.timezone.utc
NOW = dt.datetime(2025, 11, 12, 12, tzinfo=UTC)


def test_html_tree():
    t = tree("<div class='a b'><p>one<p>two <b>bold</div><br><img src=x>tail")
    assert t.find("div", cls="b").text() == "one two bold" and t.text().endswith("tail")
    assert tree(None).text() == "" and tree("<<<>>>").find("p") is None


def test_opml(spark, tmp_path):
    text = """<opml><body><outline text="g"><outline text="A" xmlUrl=" https://a.example/f " htmlUrl="https://a.example" category="tech"/>
    <outline xmlUrl="https://B.example/f"/><outline text="again" xmlUrl="https://a.example/f"/><outline text="no url"/></outline></body></opml>"""
    got = S.opml(text)
    assert [(r["title"], r["category"], r["xml_url"], r["ordinal"]) for r in got] == [("A", "tech", "https://a.example/f", 0), ("b.example", "", "https://B.example/f", 1)]
    (tmp_path / "x.opml").write_text(text)
    assert files.read_opml(spark, str(tmp_path / "x.opml")).count() == 2


def test_xml_feed():
    rss = "<rss><channel><item><title> T </title><link>https://a/1</link><pubDate>Wed, 05 Nov 2025 13:23:52 GMT</pubDate></item><item><title>T</title><link>https://a/1</link></item><item><title>x</title></item></channel></rss>"
    assert [(r["title"], r["url"], r["published_at"].isoformat()) for r in S.xml_feed(rss, NOW)] == [("T", "https://a/1", "2025-11-05T13:23:52+00:00")]
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link href="https://a/2"/><updated>2025-11-05T01:02:03Z</updated></entry></feed>'
    assert S.xml_feed(atom, NOW)[0]["url"] == "https://a/2"
    assert S.xml_feed("<rss><item>", NOW) == [] and S.xml_feed("", NOW) == []
    assert S.official_feed(rss, NOW, ("other",)) == [] and len(S.official_feed(rss, NOW, ("t https",))) == 1


def test_channel_and_posts():
    page = '<div class="tgme_widget_message x" data-post="c/5"><div class="tgme_widget_message_text">Hello <b>there</b></div><time datetime="2025-11-05T01:02:03+00:00"></time></div><div class="tgme_widget_message" data-post="c/6"><div class="tgme_widget_message_text">no time</div></div>'
    assert [(r["title"], r["url"]) for r in S.channel_page(page, NOW)] == [("Hello there", "https://t.me/c/5")]
    data = {"props": {"pageProps": {"posts": [{"id": "1", "content": "x " * 80, "createdAt": "2025-11-05T01:02:03Z"}, {"id": "2", "content": ""}, 5]}}}
    got = S.post_page(f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(data)}</script>', NOW)
    assert len(got) == 1 and got[0]["title"].endswith("…") and len(got[0]["title"]) <= 96
    assert S.post_page("<p>none</p>", NOW) == [] and S.post_page('<script id="__NEXT_DATA__">{bad</script>', NOW) == []


def test_pages():
    pub = '<div class="publisher-block"><span class="primary">P</span><div class="publisher-link"><a class="article-link" href="/x">One</a><span class="secondary">Q</span></div><div class="publisher-link"><a class="article-link" href="https://b/y">Two</a></div></div>'
    assert [(r["source"], r["url"]) for r in S.publisher_page(pub, NOW, "https://a")] == [("P · Q", "https://a/x"), ("P", "https://b/y")]
    news = '<a href="/news/1"><h3>New</h3><time>Nov 5, 2025</time></a><a href="/news/2"><h3>Old</h3><time>Jan 5, 2025</time></a><a href="/other"><h3>No</h3><time>Nov 5, 2025</time></a>'
    assert [r["title"] for r in S.news_page(news, NOW, "https://a")] == ["New"]
    log = '<ul><li id="a1"><time datetime="2025-11-05">x</time><h3>Change</h3></li><li id="a1"><time datetime="2025-11-05">x</time><h3>Change</h3></li><li><h3>no id</h3></li></ul>'
    assert [r["url"] for r in S.changelog_page(log, NOW, "https://a/c")] == ["https://a/c#a1"]
    daily = '<main><p>2025年11月5日</p><p><strong>A real headline</strong> <a href="https://a/1">阅读全文</a></p><a href="https://a/2">Another headline</a><a href="https://a/3">abc</a></main>'
    assert [(r["title"], r["url"]) for r in S.daily_page(daily, NOW)] == [("A real headline", "https://a/1"), ("Another headline", "https://a/2")]
    assert [r["url"] for r in S.heading_links('<a href="n/1"><h3>H</h3></a><a href="n/2">x</a>', NOW, "https://a/")] == ["https://a/n/1"]
    md = "Nov 5, 2025 • 3 min read ### **Big  thing** text ](https://a/p/big) Jan 1, 2025 • 3 min read ### **Old** ](https://a/p/old)"
    assert [(r["title"], r["url"]) for r in S.markdown_newsletter(md, NOW)] == [("Big thing", "https://a/p/big")]


def test_json():
    feed = json.dumps({"items": [{"title": "T", "url": "https://a.example/1", "category": "c", "date_published": "2025-11-05"}, {"title": "U", "url": "https://A.example/2"}, {"title": ""}]})
    assert [r["source"] for r in S.json_feed(feed, NOW)] == ["c", "a.example"] and S.json_feed("{bad", NOW) == []
    assert S.hot_list(json.dumps({"posts": [{"title": "T", "url": "u"}, {"title": "V", "url": "u", "time": 1762300000}]}), NOW)[0]["published_at"] == NOW
    pages = [json.dumps({"data": {"pageCount": 2, "dataList": [{"id": k, "title": f"t{k}", "createdTimestamp": 1762300000000}]}}) for k in range(3)]
    assert [r["url"] for r in S.newsletter_api(pages, NOW, "https://a")] == ["https://a/0", "https://a/1"]
    agg = json.dumps({"data": [{"id": "v2ex", "title": "V2", "updatedTime": 1762300000000, "items": [{"title": "T", "url": "u", "extra": {"date": "2025-11-05T00:00:00Z"}}, {"title": "W", "url": "w"}]}]})
    assert [(r["source"], r["published_at"].day) for r in S.aggregated(agg, NOW)] == [("V2 (v2ex)", 5), ("V2 (v2ex)", 4)]


def test_scripts():
    js = 'a={x:1};b={v2ex:vL,"hacker-news":{name:"}{",column:"c"},github:{home:"h"},v2ex:1};c={z:2}'
    assert S.source_ids(js) == ["v2ex", "hacker-news", "github"] and S.source_ids("nothing") == list(S.DEFAULT_SOURCES) and S.source_ids("{v2ex:vL,") == list(S.DEFAULT_SOURCES)
    assert S.feed_links('const feeds = ["https://a/f", \'https://b/f\',"https://a/f"];') == ["https://a/f", "https://b/f"]
    pushed = 'self.__next_f.push([1,"x:{\\"posts\\":[{\\"t\\":\\"$D2025-11-05\\",\\"u\\":\\"$undefined\\"}]}"])'
    assert S.json_at(S.flight(pushed), "posts") == [{"t": "2025-11-05", "u": None}] and S.json_at("{}", "posts") is None
    assert S.history_url('{"mention_doc":{"title":"历史更新","raw_url":"https://h"}}', "d") == "https://h" and S.history_url("", "d") == "d"


def test_dates():
    for v, want in ((1762300000, 2025), ("1762300000123", 2025), ("$D2025-01-02", 2025), ("2026-02-19 11:54:21AM UTC", 2026), ("rubbish", None), (None, None), (True, None), ("", None), (1e300, None)):
        got = S.when(v, NOW)
        assert (got.year if got else None) == want
    assert S.when("10:30", NOW).date() == NOW.date()


def test_scan_and_statuses(spark):
    docs = spark.createDataFrame(
        [(1, "xml", "s", "S", "src", "<rss><item><title>T</title><link>https://a/1</link><pubDate>Wed, 05 Nov 2025 13:23:52 GMT</pubDate></item><item><title>no date</title><link>https://a/2</link></item></rss>"), (2, "xml", "s", "S", "src", None), (3, "unheard", "s", "S", "src", "x")],
        "doc_no long, kind string, site_id string, site_name string, source string, body string",
    )
    scanned = S.scan(docs, NOW)
    assert [r.title for r in S.items(scanned).collect()] == ["T"]
    st = {r.doc_no: (r.ok, r.n_items) for r in S.statuses(scanned).collect()}
    assert st == {1: (True, 1), 2: (True, 0), 3: (False, 0)}
    assert S.items(S.scan(docs.limit(0), NOW)).count() == 0


def test_fetched(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("down")
        return f"body of {url}"

    feeds = spark.createDataFrame([(1, "xml", "s", "S", "a", "https://ok"), (2, "xml", "s", "S", "b", "https://bad")], "doc_no long, kind string, site_id string, site_name string, source string, url string")
    got = {r.doc_no: (r.body, r.error) for r in S.fetched(feeds, fetch).collect()}
    assert got == {1: ("body of https://ok", None), 2: (None, "OSError: down")}


def test_archive_files(spark, tmp_path):
    listed = {"items": [{"id": "a", "title": "1"}, {"id": "a", "title": "2"}, {"title": "no id"}, {"id": "b", "title": "3", "published_at": "2025-11-05T00:00:00Z"}]}
    (tmp_path / "l.json").write_text(json.dumps(listed, indent=1))
    assert sorted((r.id, r.title) for r in files.read_archive(spark, str(tmp_path / "l.json")).collect()) == [("a", "2"), ("b", "3")]
    (tmp_path / "m.json").write_text(json.dumps({"items": {"a": {"title": "1"}, "b": {"id": "b", "title": "2"}}}))
    assert sorted((r.id, r.title) for r in files.read_archive(spark, str(tmp_path / "m.json")).collect()) == [("a", "1"), ("b", "2")]
    (tmp_path / "x.json").write_text("{broken")
    assert files.read_archive(spark, str(tmp_path / "x.json")).count() == 0 and files.read_archive(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "c.json").write_text(json.dumps({"Hello": "你好", " ": "x", "y": " "}))
    assert [tuple(r) for r in files.read_title_cache(spark, str(tmp_path / "c.json")).collect()] == [("Hello", "你好")]


def test_caption_files(spark, tmp_path):
    body = "WEBVTT\nKind: captions\n\nNOTE hidden\n00:00:01.000 --> x\n\n1\n00:00:01.000 --> 00:00:02.500 line:15%\nA &amp; <b>B</b>\n \n\n00:02.000 --> 00:03.000\n\n01:00:00,5 --> 01:00:01,25\nlast"
    (tmp_path / "abc.NA.zh-Hans-en.vtt").write_text(body)
    got = vtt.read_files(spark, str(tmp_path)).first()
    assert (got.item_id, got.lang) == ("abc", "zh-Hans-en")
    cues = vtt.cues(body)
    assert [(c.cue_no, c.start_ms, c.end_ms, c.settings, c.lines) for c in cues] == [(1, 1000, 2500, "line:15%", ["A &amp; <b>B</b>", " "]), (2, 2000, 3000, "", []), (3, 3600500, 3601250, "", ["last"])]
    assert vtt.plain("A &amp; <b>B</b>&nbsp;&lt;i&gt;") == "A & B <i>" and vtt.cues(None) == [] and vtt.cues("WEBVTT") == []
    assert [r.item_id for r in files.captioned(spark, str(tmp_path)).collect()] == ["abc"]


def test_collect(spark):
    def bad():
        raise ValueError("nothing there")

    good = spark.createDataFrame([("a", 1)], "title string, ordinal long")
    more = spark.createDataFrame([("b", "u")], "title string, url string")
    rows, status = S.collect({"x": lambda: good, "y": bad, "z": lambda: more})
    assert rows.count() == 2 and [s["ok"] for s in status] == [True, False, True] and status[1]["error"] == "ValueError: nothing there"
    assert S.collect({"y": bad})[0] is None


def test_decode_escaped():
    assert S.decode_escaped('{\\"a\\":1}') == {"a": 1} and S.decode_escaped('{"a":1}') == {"a": 1} and S.decode_escaped("no") is None


SITE = {
    "https://a.example/rss": "<rss><channel><item><title>One</title><link>https://a.example/1</link><pubDate>Wed, 05 Nov 2025 10:00:00 GMT</pubDate></item><item><title>No date</title><link>https://a.example/2</link></item></channel></rss>",
    "https://t.me/s/chan": '<div class="tgme_widget_message" data-post="chan/1"><div class="tgme_widget_message_text">Hello there</div><time datetime="2025-11-05T10:00:00+00:00"></time></div>',
    "https://36kr.com/feed": "<rss><channel><item><title>Hot</title><link>https://36kr.com/1</link><pubDate>Wed, 05 Nov 2025 11:00:00 GMT</pubDate></item></channel></rss>",
    "https://o.example/feed": "<rss><channel><item><title>Codex ships</title><link>https://o.example/1</link><pubDate>Wed, 05 Nov 2025 11:00:00 GMT</pubDate></item><item><title>Other</title><link>https://o.example/2</link><pubDate>Wed, 05 Nov 2025 11:00:00 GMT</pubDate></item></channel></rss>",
    "https://n.example/bulk?s=a": '{"id":"a","title":"A","items":[{"title":"T","url":"https://n.example/t"}]}',
}


def get(url):
    return SITE[url]


def test_a_subscription_list_as_one_source(spark):
    from newsloom.sources import composed as C

    rows = [
        ("Zed", "tech", "https://a.example/rss", "", 0), ("Chan", "", "https://rsshub.app/telegram/channel/chan", "", 1), ("Gone", "blog", "https://gone.example/rss", "", 2),
        ("Skip", "", "https://rsshub.app/zhihu/x", "", 3), ("", "finance", "https://rsshub.app/36kr/hot-list", None, 4), ("Late", "", "https://late.example/rss", "", 5),
    ]
    subs = spark.createDataFrame(rows, "title string, category string, xml_url string, html_url string, ordinal int")
    got = C.subscribed(subs, get, NOW, max_feeds=5, tries=2, wait=0.01)
    assert sorted((r.site_id, r.source, r.title) for r in got.items.collect()) == [("finance", "", "Hot"), ("opmlrss", "Chan", "Hello there"), ("tech", "Zed", "One")]
    st = got.statuses.collect()
    assert [r.feed_title for r in st] == ["Chan", "Gone", "Skip", "Zed", ""] or [r.feed_title for r in st][:4] == ["Chan", "Gone", "Skip", "Zed"]
    by = {r.feed_url: r for r in st}
    gone = by["https://gone.example/rss"]
    assert not gone.ok and "KeyError" in gone.error and gone.n_items == 0 and gone.duration_ms >= 10
    skip = by["https://rsshub.app/zhihu/x"]
    assert skip.ok and skip.skipped and skip.skip_reason == "no_official_rss_for_source_type" and skip.effective_feed_url is None and skip.site_id == ""
    assert by["https://rsshub.app/36kr/hot-list"].replaced and by["https://rsshub.app/telegram/channel/chan"].bridge_type == "telegram"
    s = got.summary.first()
    assert (s.ok, s.partial_failures, s.feed_count, s.effective_feed_count, s.skipped_feed_count, s.replaced_feed_count, s.n_items, s.error) == (True, 1, 5, 4, 1, 2, 3, "1 feeds failed")


def test_official_branches(spark):
    import pytest

    from newsloom.sources import composed as C

    branches = [C.Branch("official", "O", "https://o.example/feed", ("codex",)), C.Branch("official", "A", "https://a.example/rss"), C.Branch("news", "N", "https://none.example/")]
    assert sorted(r.title for r in C.official(spark, branches, get, NOW).collect()) == ["Codex ships", "One"]
    with pytest.raises(ValueError, match="no items"):
        C.official(spark, branches[2:], get, NOW)


def test_feeds_of_feeds_and_fallbacks(spark):
    from newsloom.sources import composed as C

    page = "const feeds = [ {name: 'Aye', url: 'https://a.example/rss'}, { name: 'Gone', url: 'https://gone.example/rss' } ];"
    assert sorted((r.source, r.title) for r in C.feed_of_feeds(spark, page, get, NOW).collect()) == [("Aye", "No date"), ("Aye", "One")]
    some = spark.range(1)
    assert C.or_else(some, lambda: spark.range(5)).count() == 1 and C.or_else(some.limit(0), lambda: spark.range(5)).count() == 5
    got = C.bulk_or_each(spark, ["a", "b"], "https://n.example/bulk", lambda n: f"https://n.example/bulk?s={n}", get, NOW).collect()
    assert [(r.source, r.title) for r in got] == [("A (a)", "T")]
    html = '<a href="/newsletter/1">A long title <time datetime="2025-11-05">x</time></a><a href="/newsletter/2">short</a><a href="/other">A longer title</a>'
    assert [(r["url"], r["published_at"].day) for r in S.newsletter_page(html, NOW, "https://b.example")] == [("https://b.example/newsletter/1", 5)]


def test_daily_issue():
    page = """<body><h1>AI资讯日报 2025/11/5</h1><a href="https://x.example/outside">An outside link</a><article><div class="content"><ul><li><p><strong>Bold one</strong> <a href="https://x.example/1?utm_source=a">more</a></p></li></ul>
    <p><strong>Bold two</strong><a target="_blank" href="https://x.example/2">阅读全文</a></p><a target="_blank" href="https://x.example/1#top">Again the first</a></div>
    <p><a href="https://x.example/3">In the article</a><a href="https://source.hubtoday.app/z">No item here</a><a href="https://x.example/4">自媒体账号</a></p></article></body>"""
    got = [(r["title"], r["url"], r["published_at"].day) for r in S.daily_page(page, NOW)]
    assert got == [("Bold one", "https://x.example/1?utm_source=a", 5), ("Bold two", "https://x.example/2", 5), ("In the article", "https://x.example/3", 5)]
