"""Subscriptions, feeds, pages and payloads as rows.

Every parser is a pure function from text to records; ``scan`` runs one over a table of fetched
documents (source, body) in Arrow batches. A body that cannot be parsed gives no rows and an
error in ``statuses``; it never fails the job. Fetching itself is left to the caller: a fetcher is
any function from url to text, run by ``fetched`` in the tasks, one partition for a group of urls.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from dateutil import parser as lenient
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.urls import CAMPAIGN_KEYS, CAMPAIGN_PREFIX
from newsloom.runtime import cut
from newsloom.sources.html import Node, tree

UTC = dt.timezone.utc
#: Days that an official source's items may be old.
OFFICIAL_DAYS = 21

Record = dict


# ---- dates ------------------------------------------------------------------------------------


def unix(value: float) -> dt.datetime | None:
    """Seconds since 1970, milliseconds above ten billion."""
    try:
        return dt.datetime.fromtimestamp(value / 1000 if value > 1e10 else value, UTC)
    except (OverflowError, OSError, ValueError):
        return None


def when(value: object, now: dt.datetime) -> dt.datetime | None:
    """An instant from anything a feed may hold; parts that are missing come from ``now``, no zone is UTC."""
    if value is None or isinstance(value, bool):
        return None
    if isinstance(value, dt.datetime):
        return value.astimezone(UTC) if value.tzinfo else value.replace(tzinfo=UTC)
    if isinstance(value, (int, float)):
        return unix(float(value))
    text = str(value).strip().removeprefix("$D")
    if re.fullmatch(r"\d{9,}", text):
        return unix(float(text))
    if m := re.search(r"(\d{4}-\d{2}-\d{2})\s+(\d{1,2}:\d{2}:\d{2})([AP]M)\s+UTC", text):
        text = f"{m[1]} {m[2]} {m[3]} UTC"
    try:
        t = lenient.parse(text, default=now.replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=None), tzinfos={"UT": 0, "UTC": 0, "GMT": 0})
    except (ValueError, OverflowError, TypeError):
        return None
    return (t if t.tzinfo else t.replace(tzinfo=UTC)).astimezone(UTC)


def fresh(t: dt.datetime | None, now: dt.datetime, days: int = OFFICIAL_DAYS) -> bool:
    return t is not None and t >= now - dt.timedelta(days=days)


def _first(records: Iterable[Record], *keys: str) -> list[Record]:
    """The first record of each key."""
    out: dict[tuple, Record] = {}
    for r in records:
        out.setdefault(tuple(r[k] for k in keys), r)
    return list(out.values())


def _filled(*values: object) -> str:
    return next((t for v in values if v is not None and (t := str(v).strip())), "")


def _short(text: str, limit: int = 96) -> str:
    s = " ".join(text.split())
    return s if len(s) <= limit else s[: limit - 1].rstrip() + "…"


def _json_or(text: str, fallback):
    try:
        return json.loads(text)
    except ValueError:
        return fallback


# ---- subscriptions ------------------------------------------------------------------------------


def opml(text: str) -> list[Record]:
    """title, category, xml_url, html_url, ordinal of the feeds in an outline, however deep; the first of each xml_url."""
    out = []
    for o in ET.fromstring(text).iter("outline"):
        xml_url = o.get("xmlUrl", "").strip()
        if xml_url:
            html_url = o.get("htmlUrl", "").strip()
            out.append({
                "title": _filled(o.get("title"), o.get("text"), urlsplit(xml_url).netloc.lower(), xml_url),
                "category": o.get("category", "").strip(), "xml_url": xml_url, "html_url": html_url,
            })
    return [r | {"ordinal": i} for i, r in enumerate(_first(out, "xml_url"))]


# ---- feeds ---------------------------------------------------------------------------------------


def xml_feed(text: str, now: dt.datetime) -> list[Record]:
    """Items of RSS and Atom, with namespaces or without; title and link are needed, each pair once."""

    def child(node: ET.Element, *names: str) -> list[ET.Element]:
        return [c for n in names for c in node if c.tag.rpartition("}")[2] == n]

    def text_of(node: ET.Element, *names: str) -> str:
        return _filled(*[c.text for c in child(node, *names)])

    try:
        root = ET.fromstring(text.strip().encode())
    except ET.ParseError:
        return []
    out = []
    for node in root.iter():
        if node.tag.rpartition("}")[2] in ("item", "entry"):
            link = _filled(*[c.get("href") or c.text for c in child(node, "link")][:1], text_of(node, "link"))
            title = text_of(node, "title")
            if title and link:
                out.append({"title": title, "url": link, "published_at": when(text_of(node, "pubDate", "published", "updated") or None, now)})
    return _first(out, "title", "url")


def official_feed(text: str, now: dt.datetime, keywords: tuple[str, ...] = ()) -> list[Record]:
    """Fresh items of a feed that, if keywords are given, name one of them in title or link."""
    return [r for r in xml_feed(text, now) if fresh(r["published_at"], now) and (not keywords or any(k in f"{r['title']} {r['url']}".lower() for k in keywords))]


# ---- pages -------------------------------------------------------------------------------------


def channel_page(text: str, now: dt.datetime) -> list[Record]:
    """Messages of a public channel page: text or preview title, and a time."""
    out = []
    for m in tree(text).find_all(cls="tgme_widget_message"):
        post = m.attrs.get("data-post", "").strip()
        bodies = (m.find(cls="tgme_widget_message_text"), m.find(cls="tgme_widget_message_link_preview_title"))
        title = next((t for b in bodies if b and (t := b.text())), "")
        clock = m.find("time", datetime=None)
        t = when(clock.attrs["datetime"], now) if clock else None
        if post and title and t:
            out.append({"title": _short(title), "url": f"https://t.me/{post}", "published_at": t})
    return out


def next_data(text: str):
    """The JSON of a page's ``__NEXT_DATA__`` script, or null."""
    s = tree(text).find("script", id="__NEXT_DATA__")
    return _json_or(s.raw(), None) if s else None


def post_page(text: str, now: dt.datetime) -> list[Record]:
    """Posts in the data of a topic or user page."""
    data = next_data(text)
    props = ((data or {}).get("props") or {}).get("pageProps") or {}
    out = []
    for p in props.get("posts") or []:
        if isinstance(p, dict):
            key, body, t = _filled(p.get("id")), _filled(p.get("content")), when(p.get("createdAt") or p.get("actionTime"), now)
            if key and body and t:
                out.append({"title": _short(body), "url": f"https://m.okjike.com/originalPosts/{key}", "published_at": t})
    return out


def publisher_page(text: str, now: dt.datetime, base: str = "") -> list[Record]:
    """Links in the blocks of an aggregator; the source names block and link publisher where they differ."""
    out = []
    for block in tree(text).find_all("div", cls="publisher-block"):
        head = block.find("span", cls="primary") or block.find(cls="publisher-title")
        first = head.text() if head else ""
        for link in block.find_all("div", cls="publisher-link"):
            a = link.find("a", cls="article-link")
            if a is None or not a.text() or not a.attrs.get("href"):
                continue
            second = (n := link.find(cls="publisher-name") or link.find(cls="secondary")) and n.text() or ""
            clock = link.find(cls="relative-time") or link.find("time")
            stamp = clock and _filled(clock.attrs.get("datetime"), clock.attrs.get("title"), clock.attrs.get("data-time"))
            out.append({
                "title": a.text(), "url": urljoin(base, a.attrs["href"]), "source": f"{first} · {second}" if second and second != first else first, "published_at": when(stamp or None, now),
            })
    return out


def news_page(text: str, now: dt.datetime, base: str = "", prefix: str = "/news/") -> list[Record]:
    """Fresh news cards: a link under ``prefix`` with a heading and a time; each url once."""
    out = []
    for a in tree(text).find_all("a", href=None):
        url = urljoin(base, a.attrs["href"])
        if not urlsplit(url).path.startswith(prefix):
            continue
        head, clock = a.find("h1", "h2", "h3", "h4") or a.find("span", cls="title"), a.find("time")
        t = when(clock.attrs.get("datetime") or clock.text(), now) if clock else None
        if head and head.text() and fresh(t, now):
            out.append({"title": head.text(), "url": url, "published_at": t})
    return _first(out, "url")


def changelog_page(text: str, now: dt.datetime, base: str = "") -> list[Record]:
    """Fresh entries of a changelog: a list item with an id, a time and a heading; each id once."""
    out = []
    for li in tree(text).find_all("li", id=None):
        clock, head = li.find("time"), li.find("h3")
        t = when(clock.attrs.get("datetime") or clock.text(), now) if clock else None
        if head and head.text() and fresh(t, now):
            out.append({"title": head.text(), "url": f"{base}#{li.attrs['id']}", "published_at": t})
    return _first(out, "url")


# Link texts of a daily page that say nothing of the item.
PLACEHOLDERS = ("阅读全文", "查看详情", "more", "read more")


def generic_anchor(title: str) -> bool:
    return not title.strip() or title.strip().lower() in PLACEHOLDERS or bool(re.search(r"\(AI资讯\)\s*$", title))


# The date in an issue's heading, and what a daily page links that is no item.
_ISSUE_DATE = re.compile(r"AI资讯日报\s*(?:(\d{4})/(\d{1,2})/(\d{1,2})|(\d{4})-(\d{1,2})-(\d{1,2}))")
NO_ITEM_TITLES, NO_ITEM_HOSTS = ("自媒体账号",), ("source.hubtoday.app",)


def page_of(url: str) -> str:
    """The normalized url, as ``functions.urls.normalize_url`` has it for columns."""
    try:
        u = urlsplit(url.strip())
        if not u.scheme:
            return url.strip()
        kept = [(k, v) for k, v in parse_qsl(u.query, keep_blank_values=True) if not k.lower().startswith(CAMPAIGN_PREFIX) and k.lower() not in CAMPAIGN_KEYS]
        return urlunsplit((u.scheme.lower(), u.netloc.lower(), u.path, urlencode(kept), "")).rstrip("/")
    except ValueError:
        return url.strip()


def _bold_beside(a: Node) -> str:
    """The bold text of the paragraph that a link stands in."""
    n = a.parent
    while n is not None and n.tag != "p":
        n = n.parent
    strong = n.find("strong") if n is not None else None
    return strong.text() if strong else ""


def daily_page(text: str, now: dt.datetime, base: str = "") -> list[Record]:
    """Items of one issue, all with the issue's date: bold list entries, then links of the content, then of the article.

    A generic link text gives way to the bold text beside it; a page counts once, by its first item;
    only if the articles have none, links anywhere on the page count.
    """
    root = tree(text)
    date = _ISSUE_DATE.search(root.text())
    issue = when("-".join(g for g in date.groups() if g), now) if date else None
    out: dict[str, Record] = {}

    def add(title: str, url: str, source: str, bold: str = "") -> None:
        if generic_anchor(title) and bold:
            title = bold
        if len(title) >= 5 and url.startswith("http") and title not in NO_ITEM_TITLES and not any(h in url for h in NO_ITEM_HOSTS) and not generic_anchor(title):
            out.setdefault(page_of(url), {"title": title, "url": url, "source": source, "published_at": issue})

    def linked(box: Node) -> Iterator[Node]:
        return (a for a in box.find_all("a", href=None) if a.attrs["href"].startswith("http"))

    articles = list(root.find_all("article"))
    contents = [c for a in articles for c in a.find_all(cls="content")]
    for p in (p for c in contents for li in c.find_all("li") for p in li.find_all("p")):
        first, strong = next(linked(p), None), p.find("strong")
        if first is not None:
            add(strong.text() if strong else "", first.attrs["href"].strip(), "Daily Digest")
    for a in (a for c in contents for a in c.find_all("a", target="_blank")):
        add(a.text(), a.attrs.get("href", "").strip(), "Daily Digest", _bold_beside(a))
    for a in (a for box in articles for a in linked(box)):
        add(a.text(), a.attrs["href"].strip(), "Daily Digest", _bold_beside(a))
    if not out:
        for a in linked(root):
            add(a.text(), a.attrs["href"].strip(), "Page Fallback", _bold_beside(a))
    return list(out.values())


def heading_links(text: str, now: dt.datetime, base: str = "") -> list[Record]:
    """Links that hold a third-level heading."""
    out = [{"title": a.find("h3").text(), "url": urljoin(base, a.attrs["href"]), "published_at": None} for a in tree(text).find_all("a", href=None) if a.find("h3")]
    return _first((r for r in out if r["title"]), "url")


_ISSUE = re.compile(r"([A-Z][a-z]{2} \d{1,2}, \d{4})\s*•\s*\d+ min read\s*#{1,6}\s*\*\*(.+?)\*\*.*?\]\((https?://[^)\s]+/p/[^)\s]+)\)", re.S)


def markdown_newsletter(text: str, now: dt.datetime) -> list[Record]:
    """Fresh issues listed in Markdown: date, bold title, link; each url once."""
    out = [{"title": " ".join(m[2].split()), "url": m[3], "published_at": when(m[1], now)} for m in _ISSUE.finditer(text)]
    return _first((r for r in out if fresh(r["published_at"], now)), "url")


# ---- JSON ----------------------------------------------------------------------------------------


def json_feed(text: str, now: dt.datetime, site_name: str = "") -> list[Record]:
    """Items of a JSON feed; the source is the first that is named."""
    out = []
    for i in _json_or(text, {}).get("items") or []:
        url, title = _filled(i.get("url"), i.get("external_url")), _filled(i.get("title"))
        if url and title:
            source = _filled(i.get("source"), i.get("site_name"), i.get("channel"), i.get("category"), urlsplit(url).netloc.lower(), site_name)
            out.append({"title": title, "url": url, "source": source, "published_at": when(i.get("date_published") or i.get("date_modified"), now)})
    return out


def hot_list(text: str, now: dt.datetime) -> list[Record]:
    """Posts of a hot list; one without time counts as of now."""
    out = []
    for p in _json_or(text, {}).get("posts") or []:
        title, url = _filled(p.get("title")), _filled(p.get("url"))
        if title and url:
            out.append({"title": title, "url": url, "published_at": when(p.get("time"), now) or now})
    return out


def newsletter_api(pages: Iterable[str], now: dt.datetime, base: str, most: int = 12) -> list[Record]:
    """Issues of a paged API, up to the last page it names; each url once."""
    out: list[Record] = []
    for k, text in enumerate(pages):
        data = _json_or(text, {}).get("data") or {}
        for i in data.get("dataList") or []:
            title = _filled(i.get("title"))
            if title and i.get("id") is not None:
                out.append({"title": title, "url": f"{base}/{i['id']}", "published_at": when(i.get("createdTimestamp"), now)})
        if k + 1 >= min(most, int(data.get("pageCount") or most)):
            break
    return _first(out, "url")


def newsletter_page(text: str, now: dt.datetime, base: str = "") -> list[Record]:
    """Issues linked on a page: what stands in for the API where that gives none. Titles of eight characters or more."""
    out = []
    for a in tree(text).find_all("a", href=None):
        clock = a.find("time")
        if "/newsletter" in a.attrs["href"] and len(a.text()) >= 8:
            out.append({"title": a.text(), "url": urljoin(base, a.attrs["href"].strip()), "published_at": when(clock.attrs.get("datetime") or clock.text(), now) if clock else None})
    return _first(out, "url")


def aggregated(text: str, now: dt.datetime) -> list[Record]:
    """Items of many sources in one answer, or of one source in its own; the label is title and id, the date the first there is."""
    out = []
    answer = _json_or(text, [])
    blocks = answer.get("data", answer) if isinstance(answer, dict) else answer
    for block in [blocks] if isinstance(blocks, dict) else blocks if isinstance(blocks, list) else []:
        name = _filled(block.get("id")) or "unknown"
        title = _filled(block.get("title"), block.get("name"), block.get("desc"), name)
        for i in block.get("items") or []:
            head, url = _filled(i.get("title")), _filled(i.get("url"))
            if head and url:
                extra = i.get("extra") if isinstance(i.get("extra"), dict) else {}
                dates = (i.get("pubDate"), extra.get("date"), block.get("updatedTime"))
                out.append({"title": head, "url": url, "source": name if title == name else f"{title} ({name})", "published_at": next((t for d in dates if (t := when(d, now))), now)})
    return out


# Source ids when the script names none, and keys in it that are no ids.
DEFAULT_SOURCES = ("hackernews", "producthunt", "github", "sspai", "juejin", "36kr")
NO_SOURCES = ("name", "column", "home", "https", "color", "interval", "title", "type", "redirect", "desc")


def balanced(text: str, start: int) -> str | None:
    """The braces that open at ``start``, up to their closing one; braces inside strings don't count."""
    depth = 0
    for m in re.finditer(r'"(?:\\.|[^"\\])*"|[{}]', text[start:], re.S):
        depth += {"{": 1, "}": -1}.get(m[0], 0)
        if not depth and m[0] == "}":
            return text[start : start + m.end()]
    return None


def source_ids(script: str) -> list[str]:
    """Source ids in the configuration of a script, in order, each once."""
    at = script.find("{v2ex:vL")
    block = balanced(script, at) if at >= 0 else None
    if block is None:
        return list(DEFAULT_SOURCES)
    keys = re.findall(r"""["']?([A-Za-z0-9_-]+)["']?\s*:""", block)
    return [k for k in dict.fromkeys(keys) if k not in NO_SOURCES]


def feed_links(script: str) -> list[str]:
    """Feeds that a page's script lists in ``const feeds = [...]``."""
    m = re.search(r"const\s+feeds\s*=\s*\[(.*?)\]", script, re.S)
    return list(dict.fromkeys(re.findall(r"https?://[^\s\"',\]]+", m[1]))) if m else []


def named_feeds(script: str) -> list[tuple[str, str]]:
    """(name, url) of the feeds that a page's script lists in ``const feeds = [...]``."""
    m = re.search(r"const\s+feeds\s*=\s*\[(.*?)\]\s*;", script, re.S)
    return re.findall(r"\{\s*name:\s*'([^']+)'\s*,\s*url:\s*'([^']+)'\s*\}", m[1]) if m else []


def flight(text: str) -> str:
    """The chunks that a page pushes to its own script, decoded and joined."""
    chunks = re.findall(r'self\.__next_f\.push\(\[1,\s*("(?:\\.|[^"\\])*")\]\)', text, re.S)
    return "".join(c for c in (_json_or(c, None) for c in chunks) if c)


def json_at(decoded: str, key: str):
    """The JSON object or list behind ``"key":`` in decoded chunks; undefined is null, date marks go."""
    m = re.search(rf'"{re.escape(key)}"\s*:\s*(?=[\[{{])', decoded)
    if not m:
        return None
    raw = re.sub(r'"\$D', '"', decoded[m.end() :].replace('"$undefined"', "null"))
    try:
        return json.JSONDecoder().raw_decode(raw)[0]
    except ValueError:
        return None


def history_url(text: str, default: str) -> str:
    """The linked document whose title names the update history."""
    for m in re.finditer(r'\{[^{}]*"mention_doc"\s*:\s*(\{[^{}]*\})', text.replace('\\"', '"')):
        doc = _json_or(m[1], {})
        if any(w in _filled(doc.get("title")) for w in ("历史更新", "更新日志")) and doc.get("raw_url"):
            return doc["raw_url"]
    return default


# ---- scans ---------------------------------------------------------------------------------------

Parser = Callable[[str, dt.datetime], list[Record]]
#: Parsers by the kind of document; more may be registered.
PARSERS: dict[str, Parser] = {
    "xml": xml_feed, "official": official_feed, "telegram": channel_page, "jike": post_page, "publishers": publisher_page, "news": news_page,
    "changelog": changelog_page, "daily": daily_page, "headings": heading_links, "markdown": markdown_newsletter, "json": json_feed, "hot": hot_list, "aggregated": aggregated,
    "newsletter": lambda text, now: newsletter_api([text], now, ""), "newsletter_page": newsletter_page,
}
#: Kinds whose items need a date.
DATED = ("xml", "telegram", "jike")

_SCAN = "site_id string, site_name string, source string, kind string, doc_no long, item_no int, title string, url string, published_at timestamp, n_items int, error string"


def scan(documents: DataFrame, now: dt.datetime, parsers: dict[str, Parser] | None = None) -> DataFrame:
    """Items of fetched documents (doc_no, kind, site_id, site_name, source, body), and one row with item_no -1 for each document's outcome.

    Two columns more may be there: ``error`` of a fetch that failed, which is the outcome then, and
    ``keywords`` (array of string), of which an item of an official feed must name one.
    """
    table = PARSERS | (parsers or {})
    more = [c for c in ("error", "keywords") if c in documents.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for d in b.itertuples(index=False):
                error, items = getattr(d, "error", None), []
                words = getattr(d, "keywords", None)
                try:
                    if error is None:
                        items = official_feed(d.body or "", now, tuple(words)) if d.kind == "official" and words is not None else table[d.kind](d.body or "", now)
                    if d.kind in DATED:
                        items = [i for i in items if i["published_at"] is not None]
                except Exception as e:  # noqa: BLE001  one bad document must not fail the scan
                    error = f"{type(e).__name__}: {e}"[:200]
                base = (d.site_id, d.site_name)
                for k, i in enumerate(items):
                    rows.append((*base, i.get("source") or d.source, d.kind, d.doc_no, k, i["title"], i["url"], i["published_at"], None, None))
                rows.append((*base, d.source, d.kind, d.doc_no, -1, None, None, None, len(items), error))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCAN.split(", ")]).astype({"n_items": "Int32"})

    return documents.select("doc_no", "kind", "site_id", "site_name", "source", "body", *more).mapInPandas(run, _SCAN)


def items(scanned: DataFrame) -> DataFrame:
    """Raw items of a scan, with the ordinal that upserts go by."""
    return scanned.where("item_no >= 0").select(
        (F.col("doc_no") * 1_000_000 + F.col("item_no")).alias("ordinal"), "site_id", "site_name", "source", "title", "url", "published_at"
    )


def statuses(scanned: DataFrame) -> DataFrame:
    """One row a document: ok, number of items, error."""
    return scanned.where("item_no < 0").select("doc_no", "site_id", "site_name", "source", "kind", F.col("error").isNull().alias("ok"), "n_items", "error")


#: Status codes after which a fetch is tried again; an error without a code is, too.
RETRIED = (429, 500, 502, 503, 504)


def fetched(feeds: DataFrame, fetch: Callable[[str], str], tries: int = 3, wait: float = 0.8) -> DataFrame:
    """doc_no, kind, site_id, site_name, source, body, error, duration_ms of (doc_no, kind, site_id, site_name, source, url): each url read in its task.

    A fetch that fails is tried again after a pause that doubles, unless its error carries a status
    code (``code`` or ``status``) that is not one of RETRIED. Other columns are kept.
    """
    kept = [f for f in feeds.schema.fields if f.name != "url"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "body string", "error string", "duration_ms long"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bodies, errors, durations = [], [], []
            for url in b["url"]:
                body = error = None
                began = time.monotonic()
                for k in range(tries):
                    if k:
                        time.sleep(wait * 2 ** (k - 1))
                    try:
                        body, error = fetch(url), None
                        break
                    except Exception as e:  # noqa: BLE001
                        error = f"{type(e).__name__}: {e}"[:200]
                        code = getattr(e, "code", getattr(e, "status", None))
                        if code is not None and code not in RETRIED:
                            break
                bodies.append(body)
                errors.append(error)
                durations.append(int((time.monotonic() - began) * 1000))
            yield b[[f.name for f in kept]].assign(body=pd.Series(bodies, b.index, dtype=object), error=pd.Series(errors, b.index, dtype=object), duration_ms=durations)

    return feeds.mapInPandas(run, schema)


def union(*parts: DataFrame) -> DataFrame:
    """All adapters' items; columns that one lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def collect(adapters: dict[str, Callable[[], DataFrame]]) -> tuple[DataFrame | None, list[Record]]:
    """Items of all adapters, and a status each: one that fails gives no items and keeps its error."""
    parts, found = [], []
    for name, make in adapters.items():
        try:
            part = cut(make(), "adapter")
            n = part.count()
        except Exception as e:  # noqa: BLE001  one adapter must not take the others down
            found.append({"site_id": name, "ok": False, "n_items": 0, "error": f"{type(e).__name__}: {e}"[:200]})
            continue
        found.append({"site_id": name, "ok": True, "n_items": n, "error": None})
        parts.append(part)
    return (union(*parts) if parts else None), found


def decode_escaped(text: str):
    """JSON whose quotes and backslashes were escaped once more, or null."""
    plain = _json_or(text, None)
    if isinstance(plain, (dict, list)):
        return plain
    return _json_or(text.replace('\\"', '"').replace("\\\\", "\\"), None)
