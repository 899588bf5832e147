"""Queries of the feed, archive, view, story, brief and caption operators over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import feeds as rules
from newsloom.functions import ids, text, times, titles, urls
from newsloom.functions.udf import similarity, undo_mojibake
from newsloom.operators import archive, blocks, captions, items, likeness, stats, stories, view
from newsloom.plans.dims import importance_of
from newsloom.runtime import cut, table
from newsloom.sources.vtt import explode_cues

UTC = dt.timezone.utc
#: The clock of all queries: inside the archive's month.
NOW = dt.datetime(2025, 11, 12, tzinfo=UTC)
#: The archive before this is the state, the rows from it on are the new batch.
CUT = dt.datetime(2025, 11, 5, tzinfo=UTC)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registering(found: dict, oracle: dict[str, str]):
    """A decorator that registers a query under its name, with the SQL that gives the same rows."""

    def query(sql: str | None = None):
        def add(f):
            found[f.__name__] = f
            if sql is not None:
                oracle[f.__name__] = sql
            return f

        return add

    return query


query = registering(_QUERIES, ORACLE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _state(spark: SparkSession, d: str) -> DataFrame:
    """The archive by id at the cut: the first row of each id."""
    before = table(spark, d, "archive_item").where(F.col("first_seen_at") < F.lit(CUT))
    w = Window.partitionBy("id").orderBy("ordinal")
    return before.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _batch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").where(F.col("first_seen_at") >= F.lit(CUT))


def _upserted(spark: SparkSession, d: str) -> DataFrame:
    return archive.upsert(_state(spark, d), archive.ingestible(_batch(spark, d)), NOW)


def _viewed(spark: SparkSession, d: str) -> DataFrame:
    """The view over the archive's rows as they came, one for each id."""
    once = table(spark, d, "archive_item").withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("ordinal"))).where("_n = 1").drop("_n")
    return view.window(archive.ingestible(once), NOW)


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Display items without repeats, written once: the stories read them several times."""
    shown = cut(view.displayed(_viewed(spark, d)), "shown")
    return cut(items.suppressed(items.distinct_items(items.daily_items(shown))), "items")


def _stories(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d)
    return stories.records(rows, cut(stories.merged(rows), "merged"), NOW, view.WINDOW_HOURS)


# ---- SQL pieces ----------------------------------------------------------------------------------

_WS = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _norm(u: str, keep: str) -> str:
    """A normalized url; ``keep`` tests the lower-case key ``k``."""
    u = f"({u})"
    scheme = f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"
    host = f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
    path = f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)"
    parts = f"list_filter(string_split(regexp_extract({u}, '^[^?#]*[?]([^#]*)', 1), '&'), lambda p: p <> '' AND {keep.format(k="lower(split_part(p, '=', 1))")})"
    query = f"list_aggregate(list_transform({parts}, lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), 'string_agg', '&')"
    return f"CASE WHEN {scheme} = '' THEN {u} ELSE regexp_replace({scheme} || '://' || {host} || {path} || CASE WHEN len({parts}) > 0 THEN '?' || {query} ELSE '' END, '/+$', '') END"


_CAMPAIGN = "{k} NOT LIKE 'utm\\_%' ESCAPE '\\' AND {k} NOT IN ('ref', 'spm', 'fbclid', 'gclid', 'igshid', 'mkt_tok', 'mc_cid', 'mc_eid', '_hsenc', '_hsmi')"
_IDENTITY = "{k} IN ('id', 'item', 'p')"
_NOW = "TIMESTAMPTZ '2025-11-12 00:00:00+00'"
_CUT = "TIMESTAMPTZ '2025-11-05 00:00:00+00'"
_EVENT = "CASE WHEN site_id = 'opmlrss' THEN published_at ELSE coalesce(published_at, first_seen_at) END"
_ONCE = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ordinal) AS n_ FROM archive_item) WHERE n_ = 1)"
_VIEW = f"(SELECT *, {_EVENT} AS event_at FROM {_ONCE} WHERE trim(title) <> '' AND url LIKE 'http%' AND {_EVENT} >= {_NOW} - INTERVAL 24 HOUR)"
_TIER = """CASE lower(site_id) WHEN 'official_ai' THEN 'official' WHEN 'aibreakfast' THEN 'ai_vertical' WHEN 'aihubtoday' THEN 'ai_vertical' WHEN 'aibase' THEN 'ai_vertical'
 WHEN 'bestblogs' THEN 'ai_vertical' WHEN 'followbuilders' THEN 'builders' WHEN 'opmlrss' THEN 'opmlrss' WHEN 'blog' THEN 'blog' WHEN 'business' THEN 'business' WHEN 'convivium' THEN 'convivium'
 WHEN 'culture' THEN 'culture' WHEN 'design' THEN 'design' WHEN 'finance' THEN 'finance' WHEN 'tech' THEN 'tech' WHEN 'techurls' THEN 'trending' WHEN 'buzzing' THEN 'trending'
 WHEN 'iris' THEN 'trending' WHEN 'zeli' THEN 'trending' WHEN 'newsnow' THEN 'trending' ELSE 'other' END"""
_RANK = "CASE {t} WHEN 'official' THEN 0 WHEN 'ai_vertical' THEN 1 WHEN 'builders' THEN 2 WHEN 'opmlrss' THEN 4 WHEN 'trending' THEN 5 WHEN 'other' THEN 9 ELSE 3 END"
_WEIGHT = "CASE {t} WHEN 'official' THEN 1.0 WHEN 'ai_vertical' THEN 0.78 WHEN 'builders' THEN 0.62 WHEN 'trending' THEN 0.32 WHEN 'opmlrss' THEN 0.25 WHEN 'other' THEN 0.25 ELSE 0.5 END"
_STOP = ", ".join(f"'{w}'" for w in titles.STOPWORDS)
_TOKENS = (
    "list_distinct(list_filter(regexp_extract_all(regexp_replace(lower({t}), 'https?://\\S+', ' ', 'g'), '([a-z0-9]+|[\\x{{4e00}}-\\x{{9fff}}]{{2,}})', 1), "
    f"lambda w: length(w) >= 2 AND w NOT IN ({_STOP})))"
)


# ---- urls and ids --------------------------------------------------------------------------------


@query(f"SELECT ordinal, {_norm(_strip('url'), _CAMPAIGN)} AS page FROM raw_item")
def url_normalized(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_item").select("ordinal", urls.normalize_url(F.col("url")).alias("page"))


@query(f"SELECT page, count(*) AS n_items, min(ordinal) AS first_ordinal FROM (SELECT ordinal, {_norm(_strip('url'), _IDENTITY)} AS page FROM archive_item) GROUP BY page")
def url_canonical_groups(spark: SparkSession, d: str) -> DataFrame:
    page = urls.canonical_story_url(F.col("url")).alias("page")
    return table(spark, d, "archive_item").select("ordinal", page).groupBy("page").agg(F.count("*").alias("n_items"), F.min("ordinal").alias("first_ordinal"))


@query("SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, count(*) AS n FROM archive_item GROUP BY 1")
def url_hosts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").groupBy(urls.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query(f"SELECT ordinal, sha1(lower(trim(site_id)) || '||' || lower(trim(source)) || '||' || lower(trim(title)) || '||' || {_norm('trim(url)', _CAMPAIGN)}) AS item_id FROM archive_item")
def id_of_items(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "archive_item")
    return a.select("ordinal", ids.item_id(F.col("site_id"), F.col("source"), F.col("title"), F.col("url")).alias("item_id"))


@query(f"SELECT ordinal, 'story_' || substr(sha1({_norm('trim(url)', _IDENTITY)}), 1, 12) AS story_id FROM archive_item")
def id_of_stories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", ids.story_id(F.col("url"), F.col("title"), F.col("id")).alias("story_id"))


@query("SELECT ordinal, substr(sha1(xml_url), 1, 10) AS feed_id FROM feed_subscription")
def id_of_feeds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "feed_subscription").select("ordinal", ids.feed_id(F.col("xml_url")).alias("feed_id"))


@query("""
SELECT ordinal, coalesce(nullif(regexp_extract(url, '[?&]v=([\\w-]{6,})', 1), ''), nullif(regexp_extract(url, '/shorts/([\\w-]{6,})', 1), ''), nullif(regexp_extract(url, '/live/([\\w-]{6,})', 1), '')) AS video_id FROM archive_item""")
def url_video_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", urls.video_id(F.col("url")).alias("video_id"))


# ---- titles and texts ----------------------------------------------------------------------------


@query("""
SELECT ordinal, CASE WHEN length(s) <= 40 THEN s ELSE regexp_replace(substr(s, 1, 39), '\\s+$', '') || '…' END AS short
FROM (SELECT ordinal, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS s FROM archive_item)""")
def title_clipped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", titles.clip(F.col("title"), 40).alias("short"))


@query(f"SELECT ordinal, list_sort({_TOKENS.format(t='title')}) AS words, len({_TOKENS.format(t='title')}) >= 4 AND length(title) >= 18 AS mergeable FROM archive_item")
def title_words(spark: SparkSession, d: str) -> DataFrame:
    words = titles.tokens(F.col("title"))
    return table(spark, d, "archive_item").select("ordinal", F.array_sort(words).alias("words"), titles.mergeable(F.col("title"), words).alias("mergeable"))


@query("""
SELECT ordinal, regexp_matches(title, '[\\x{4e00}-\\x{9fff}]') AS han,
       trim(title) <> '' AND NOT regexp_matches(title, '[\\x{4e00}-\\x{9fff}]') AND length(regexp_replace(title, '[^A-Za-z]', '', 'g')) >= greatest(6, length(trim(title)) // 4) AS english
FROM archive_item""")
def title_language(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    return table(spark, d, "archive_item").select("ordinal", titles.has_han(t).alias("han"), titles.mostly_english(t).alias("english"))


@query("""
SELECT ordinal, list_sort(list_distinct(list_filter([CASE WHEN contains(lower(title), 'openai') THEN 'openai' END, CASE WHEN contains(lower(title), 'claude') OR contains(lower(title), 'anthropic') THEN 'anthropic' END,
 CASE WHEN contains(lower(title), 'google') OR contains(lower(title), 'deepmind') OR contains(lower(title), 'gemini') THEN 'google' END, CASE WHEN contains(lower(title), 'microsoft') THEN 'microsoft' END,
 CASE WHEN contains(lower(title), 'github') THEN 'github' END, CASE WHEN contains(lower(title), 'huggingface') OR contains(lower(title), 'hugging face') THEN 'huggingface' END,
 CASE WHEN contains(lower(title), 'meta') OR contains(lower(title), 'llama') THEN 'meta' END, CASE WHEN contains(lower(title), 'deepseek') THEN 'deepseek' END,
 CASE WHEN contains(lower(title), 'mistral') THEN 'mistral' END, CASE WHEN contains(lower(title), 'xai') OR contains(lower(title), 'grok') THEN 'xai' END], lambda v: v IS NOT NULL))) AS vendors
FROM archive_item""")
def title_vendors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", titles.vendors(F.col("title")).alias("vendors"))


@query("SELECT ordinal, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS story_title FROM archive_item")
def title_of_story(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", titles.story_title(F.col("title")).alias("story_title"))


@query("""
SELECT doc_id, md5(replace(regexp_replace(replace(regexp_replace(text, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\\b', '[redacted-email]', 'g'), 'sk-hynix', 'sk-' || chr(1)),
 '(?i)\\b(sk-[A-Za-z0-9_-]{12,}|(?:api[_-]?key|secret|token)=([^\\s&]{6,}))\\b', '[redacted-secret]', 'g'), 'sk-' || chr(1), 'sk-hynix')) AS clean FROM documents""")
def text_redacted(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.md5(titles.redact(t)).alias("clean"))


@query("SELECT ordinal, coalesce(nullif(trim(summary), ''), nullif(trim(site_name), ''), nullif(trim(source), ''), '') AS filled FROM archive_item")
def text_first_filled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", text.first_non_empty(F.col("summary"), F.col("site_name"), F.col("source")).alias("filled"))


@query()
def title_mojibake_undone(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_item").where("title is not null")
    return raw.select("ordinal", "title", undo_mojibake("title").alias("fixed")).where("title <> fixed").select("ordinal", "fixed")


@query("""
SELECT ordinal, regexp_matches(title || ' ' || coalesce(summary, ''), '(?i)(^|[^a-z0-9])(ai|aigc|llm|gpt|openai|anthropic|deepseek|gemini|claude|robot|robotics|embodied|autonomous|machine learning|artificial intelligence|transformer|diffusion)([^a-z0-9]|$)')
 OR regexp_matches(lower(title || ' ' || coalesce(summary, '')), 'aigc|llm|gpt|claude|gemini|deepseek|openai|anthropic|copilot|codex|mcp|hugging face|huggingface|transformer|prompt|diffusion|多模态|大模型|人工智能|机器学习|深度学习|智能体|算力|微调') AS signal
FROM archive_item""")
def text_ai_signal(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "title", F.coalesce("summary", F.lit("")))
    return table(spark, d, "archive_item").select("ordinal", titles.ai_signal(t).alias("signal"))


# ---- times ---------------------------------------------------------------------------------------


@query("""
SELECT ordinal, strftime(published_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(published_at) % 1000000 <> 0 THEN '.' || lpad((epoch_us(published_at) % 1000000)::VARCHAR, 6, '0') ELSE '' END || 'Z' AS iso
FROM archive_item""")
def time_iso(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", times.iso(F.col("published_at")).alias("iso"))


@query("SELECT ordinal, CASE WHEN x > 10000000000 THEN floor(x / 1000) ELSE floor(x) END::BIGINT AS seconds FROM (SELECT ordinal, TRY_CAST(published_at AS DOUBLE) AS x FROM raw_item)")
def time_from_unix(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_item")
    return raw.select("ordinal", F.floor(F.unix_micros(times.from_unix(F.col("published_at"))) / 1_000_000).alias("seconds"))


@query()
def time_parsed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_item").select("ordinal", F.unix_micros(times.parse(F.col("published_at"))).alias("micros"))


@query(f"SELECT ordinal, round(CASE WHEN e IS NULL THEN 0 ELSE greatest(0, least(1, (168 - greatest(0, (epoch_us({_NOW}) - epoch_us(e)) / 3600000000.0)) / 168)) END, 6) AS recency FROM (SELECT ordinal, {_EVENT} AS e FROM archive_item)")
def time_recency(spark: SparkSession, d: str) -> DataFrame:
    a = view.with_event_time(table(spark, d, "archive_item"))
    return a.select("ordinal", F.round(times.recency(F.col("event_at"), NOW, 168), 6).alias("recency"))


# ---- subscriptions ---------------------------------------------------------------------------------


@query("""
SELECT ordinal, xml_url AS url, NULL::VARCHAR AS reason FROM feed_subscription WHERE xml_url NOT LIKE 'https://rsshub.app/%'
 AND xml_url NOT LIKE 'https://wechat2rss.bestblogs.dev/%' AND xml_url NOT LIKE 'https://werss.bestblogs.dev/%'""")
def feed_resolved(spark: SparkSession, d: str) -> DataFrame:
    r = rules.resolve(F.col("xml_url"))
    return table(spark, d, "feed_subscription").withColumn("r", r).select("ordinal", "r.url", "r.reason")


@query()
def feed_bridges(spark: SparkSession, d: str) -> DataFrame:
    b = rules.bridge(F.col("xml_url"), F.col("html_url"))
    return table(spark, d, "feed_subscription").withColumn("b", b).select("ordinal", "b.bridge_type", "b.bridge_kind", "b.bridge_slug", "b.url")


@query("SELECT ordinal, lower(regexp_extract(xml_url, '://([^/?#]*)', 1)) LIKE '%.test' AS allowed FROM feed_subscription")
def feed_domain_allowed(spark: SparkSession, d: str) -> DataFrame:
    hosts = table(spark, d, "feed_subscription").select("ordinal", urls.host_of(F.col("xml_url")).alias("host"))
    suffix = F.transform(F.array(F.lit("test")), lambda x: x)
    return hosts.select("ordinal", rules.domain_allowed(F.col("host"), suffix).alias("allowed"))


@query("SELECT xml_url, min(ordinal) AS ordinal, arg_min(title, ordinal) AS title FROM feed_subscription WHERE xml_url <> '' GROUP BY xml_url")
def feed_distinct(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "feed_subscription").where("xml_url <> ''")
    return f.groupBy("xml_url").agg(F.min("ordinal").alias("ordinal"), F.min_by("title", "ordinal").alias("title"))


# ---- archive -----------------------------------------------------------------------------------------

_STATE = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ordinal) AS n_ FROM archive_item WHERE first_seen_at < {_CUT}) WHERE n_ = 1)"
_NEW = f"""(SELECT id, arg_max(site_id, ordinal) AS site_id, arg_max(source, ordinal) AS source, arg_max(title, ordinal) AS title, arg_max(url, ordinal) AS url, min(ordinal) AS ordinal,
 arg_min(published_at, ordinal) FILTER (published_at IS NOT NULL) AS first_p, arg_max(published_at, ordinal) FILTER (published_at IS NOT NULL) AS last_p
 FROM archive_item WHERE first_seen_at >= {_CUT} AND trim(title) <> '' AND url LIKE 'http%' GROUP BY id)"""
_UPSERT = f"""
SELECT coalesce(a.id, b.id) AS id, coalesce(b.site_id, a.site_id) AS site_id, coalesce(b.source, a.source) AS source, coalesce(b.title, a.title) AS title, coalesce(b.url, a.url) AS url,
 CASE WHEN b.id IS NULL THEN a.published_at WHEN b.site_id = 'opmlrss' THEN coalesce(b.last_p, a.published_at) ELSE coalesce(a.published_at, b.first_p) END AS published_at,
 CASE WHEN a.id IS NULL THEN {_NOW} ELSE a.first_seen_at END AS first_seen_at, CASE WHEN b.id IS NOT NULL THEN {_NOW} ELSE a.last_seen_at END AS last_seen_at,
 CASE WHEN a.id IS NULL THEN false ELSE a.star END AS star, a.summary AS summary, coalesce(a.ordinal, b.ordinal) AS ordinal
FROM {_STATE} a FULL OUTER JOIN {_NEW} b ON a.id = b.id"""
_SAFE = ["id", "site_id", "source", "title", "url", "ordinal"]


def _clock(c: str) -> str:
    return f"epoch_us({c}) AS {c}"


@query(f"SELECT {', '.join(_SAFE)}, star, summary, {_clock('published_at')}, {_clock('first_seen_at')}, {_clock('last_seen_at')} FROM ({_UPSERT})")
def archive_upserted(spark: SparkSession, d: str) -> DataFrame:
    u = _upserted(spark, d)
    return u.select(*_SAFE, "star", "summary", *[F.unix_micros(c).alias(c) for c in ("published_at", "first_seen_at", "last_seen_at")])


@query(f"SELECT id, ordinal FROM ({_UPSERT}) WHERE coalesce(last_seen_at, published_at, first_seen_at, {_NOW}) >= {_NOW} - INTERVAL 14 DAY")
def archive_retained(spark: SparkSession, d: str) -> DataFrame:
    return archive.retained(_upserted(spark, d), NOW, 14).select("id", "ordinal")


@query(f"SELECT ordinal FROM raw_item WHERE {_strip('title')} <> '' AND {_strip('url')} LIKE 'http%'")
def archive_ingestible(spark: SparkSession, d: str) -> DataFrame:
    return archive.ingestible(table(spark, d, "raw_item")).select("ordinal")


@query("""
SELECT a.ordinal, a.id FROM archive_item a WHERE a.id IS NOT NULL AND (a.url LIKE '%vids.example%' OR a.url LIKE '%youtube.com%' OR a.url LIKE '%youtu.be%') AND a.summary IS NULL
 AND NOT EXISTS (SELECT 1 FROM subtitles s WHERE s.item_id = a.id)""")
def archive_pending_captions(spark: SparkSession, d: str) -> DataFrame:
    return captions.pending(table(spark, d, "archive_item"), table(spark, d, "subtitles"), None).select("ordinal", "id")


# ---- view ------------------------------------------------------------------------------------------


@query(f"SELECT id, ordinal, epoch_us(event_at) AS event_us FROM {_VIEW}")
def view_window(spark: SparkSession, d: str) -> DataFrame:
    return _viewed(spark, d).select("id", "ordinal", F.unix_micros("event_at").alias("event_us"))


@query(f"SELECT ordinal, t AS source_tier, {_RANK.format(t='t')} AS source_tier_rank, {_WEIGHT.format(t='t')}::DOUBLE AS weight FROM (SELECT ordinal, {_TIER} AS t FROM archive_item)")
def view_tiers(spark: SparkSession, d: str) -> DataFrame:
    a = view.with_tier(table(spark, d, "archive_item"))
    return a.select("ordinal", "source_tier", "source_tier_rank", importance_of(F.col("source_tier")).alias("weight"))


@query("SELECT ordinal, CASE WHEN trim(source) <> '' THEN trim(source) ELSE regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') END AS shown FROM archive_item")
def view_sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", view.display_source(F.col("site_id"), F.col("source"), F.col("url")).alias("shown"))


@query(f"""
WITH d AS (SELECT ordinal, title, {_norm('trim(url)', _CAMPAIGN)} AS page, regexp_matches(title, '[\\x{{4e00}}-\\x{{9fff}}]') AS han,
 trim(title) <> '' AND NOT regexp_matches(title, '[\\x{{4e00}}-\\x{{9fff}}]') AND length(regexp_replace(title, '[^A-Za-z]', '', 'g')) >= greatest(6, length(trim(title)) // 4) AS english FROM archive_item),
 z AS (SELECT page, arg_max(title, ordinal) AS zh FROM d WHERE han GROUP BY page)
SELECT d.ordinal, CASE WHEN d.english THEN d.title END AS title_en, CASE WHEN d.han THEN d.title WHEN d.english THEN z.zh END AS title_zh FROM d LEFT JOIN z USING (page)""")
def view_bilingual(spark: SparkSession, d: str) -> DataFrame:
    cache = spark.createDataFrame([], "title string, title_zh string")
    b = view.bilingual(table(spark, d, "archive_item"), cache)
    return b.select("ordinal", "title_en", "title_zh")


@query(f"""
SELECT ordinal FROM (SELECT ordinal, row_number() OVER (PARTITION BY lower(trim(title)) || '||' || {_norm('trim(url)', _CAMPAIGN)} ORDER BY {_EVENT} DESC NULLS LAST, id DESC, ordinal DESC) AS n FROM archive_item) WHERE n = 1""")
def items_distinct(spark: SparkSession, d: str) -> DataFrame:
    return items.distinct_items(view.with_event_time(table(spark, d, "archive_item"))).select("ordinal")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT lower(trim(title)) || '||' || " + _norm("trim(url)", _CAMPAIGN) + " FROM archive_item)")
def items_random_pick(spark: SparkSession, d: str) -> DataFrame:
    """One item of each group by a seeded hash; only their number has an equal in SQL."""
    return items.distinct_items(view.with_event_time(table(spark, d, "archive_item")), seed=7).agg(F.count("*").alias("n"))


@query("""
SELECT ordinal FROM (SELECT ordinal, site_id, row_number() OVER (PARTITION BY CASE WHEN site_id = 'official_ai' THEN url ELSE ordinal::VARCHAR END
 ORDER BY event_at DESC NULLS LAST, id DESC, ordinal DESC) AS n FROM (SELECT *, CASE WHEN site_id = 'opmlrss' THEN published_at ELSE coalesce(published_at, first_seen_at) END AS event_at FROM archive_item)) WHERE n = 1""")
def items_daily(spark: SparkSession, d: str) -> DataFrame:
    return items.daily_items(view.with_event_time(table(spark, d, "archive_item")), "official_ai").select("ordinal")


@query()
def items_near_repeats(spark: SparkSession, d: str) -> DataFrame:
    return items.near_repeats(items.distinct_items(view.displayed(_viewed(spark, d))))


@query(f"SELECT ordinal FROM archive_item WHERE id NOT IN (SELECT id FROM archive_item WHERE first_seen_at < {_CUT})")
def items_excluded(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "archive_item")
    return items.without(a, a.where(F.col("first_seen_at") < F.lit(CUT))).select("ordinal")


@query(f"""
WITH w AS (SELECT ordinal, list_sort({_TOKENS.format(t='title')}) AS words FROM archive_item), n AS (SELECT ordinal, words, array_to_string(words, ' ') AS key FROM w WHERE len(words) > 0),
 c AS (SELECT key, min(ordinal) AS rep, any_value(words) AS words FROM n GROUP BY key), k AS (SELECT rep, unnest(words) AS word FROM c),
 p AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM k a JOIN k b ON a.word = b.word AND a.rep <> b.rep),
 l AS (SELECT p.a AS rep, count(*) AS links FROM p JOIN c x ON x.rep = p.a JOIN c y ON y.rep = p.b
  WHERE len(list_intersect(x.words, y.words)) >= 0.8 * len(list_distinct(list_concat(x.words, y.words))) GROUP BY 1)
SELECT n.ordinal, c.rep AS class_ordinal, coalesce(l.links, 0) AS n_links FROM n JOIN c USING (key) LEFT JOIN l ON l.rep = c.rep""")
def title_jaccard_links(spark: SparkSession, d: str) -> DataFrame:
    """Each title with the class of titles of the same words, and with how many other classes share four fifths of the words.

    Only classes are compared, and most of them are counted at shared subsets of their words, without pairs.
    """
    words = F.array_sort(titles.tokens(F.col("title")))
    n = table(spark, d, "archive_item").select("ordinal", F.array_join(words, " ").alias("key")).where("key <> ''")
    classes = cut(n.groupBy("key").agg(F.min("ordinal").alias("rep")), "classes")
    links = likeness.alike(classes.select("rep", F.split("key", " ").alias("words")))
    c = classes.join(links, "rep", "left").select("key", F.col("rep").alias("class_ordinal"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return n.join(c, "key").select("ordinal", "class_ordinal", "n_links")


# ---- stories -----------------------------------------------------------------------------------------


@query(f"""
WITH v AS (SELECT *, {_norm('trim(url)', _IDENTITY)} AS page, {_TIER} AS t FROM {_VIEW}),
 c AS (SELECT page, count(*) AS n, min(event_at) AS e0, max(event_at) AS e1 FROM v GROUP BY page),
 s AS (SELECT v.*, c.n, c.e0, c.e1, round(greatest(0, least(1, 0.5 * {_WEIGHT.format(t='t')} + 0.3 * CASE WHEN event_at IS NULL THEN 0 ELSE greatest(0, least(1, (24 - greatest(0, (epoch_us({_NOW}) - epoch_us(event_at)) / 3600000000.0)) / 24)) END
   + 0.2 * least(1, greatest(0, (c.n - 1) / 4.0)))), 4) AS score FROM v JOIN c USING (page))
SELECT 'story_' || substr(sha1(page), 1, 12) AS story_id, n AS item_count, score, ordinal AS primary_ordinal, epoch_us(e0) AS earliest, epoch_us(e1) AS latest
FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY {_RANK.format(t='t')}, score DESC, epoch_us(event_at) DESC, title, ordinal) AS k FROM s) WHERE k = 1""")
def story_of_pages(spark: SparkSession, d: str) -> DataFrame:
    """Stories by canonical url alone: the aggregate of a story, without title merging."""
    v = _viewed(spark, d)
    assigned = v.select("id", "ordinal", ids.story_id(F.col("url"), F.col("title"), F.col("id")).alias("story_id"))
    r = stories.records(v, assigned, NOW)
    first = v.select(F.col("id").alias("p_id"), F.col("ordinal").alias("primary_ordinal"))
    return r.join(first, r["primary_item.id"] == first["p_id"]).select(
        "story_id", "item_count", "score", "primary_ordinal", F.unix_micros("earliest_at").alias("earliest"), F.unix_micros("latest_at").alias("latest")
    )


@query()
def story_merged(spark: SparkSession, d: str) -> DataFrame:
    return stories.merged(_items(spark, d))


@query()
def story_merge_events(spark: SparkSession, d: str) -> DataFrame:
    return stories.merge_events(stories.merged(_items(spark, d)))


@query()
def story_records(spark: SparkSession, d: str) -> DataFrame:
    return stories.in_order(_stories(spark, d))


@query()
def story_brief(spark: SparkSession, d: str) -> DataFrame:
    return stories.brief(_stories(spark, d))


@query(f"""
WITH s AS (SELECT ordinal, source, title, round((0.5 * {_WEIGHT.format(t='t')} + 0.1)::DOUBLE, 4) AS score FROM (SELECT ordinal, source, title, {_TIER} AS t FROM {_VIEW})),
 r AS (SELECT *, round(score - 0.03 * (row_number() OVER (PARTITION BY source ORDER BY score DESC, title, ordinal::VARCHAR) - 1), 4)::DOUBLE AS effective FROM s)
SELECT ordinal::VARCHAR AS story_id, effective::DOUBLE AS effective FROM r ORDER BY effective DESC, score DESC, title, ordinal::VARCHAR LIMIT 20""")
def story_penalised(spark: SparkSession, d: str) -> DataFrame:
    v = view.with_tier(_viewed(spark, d))
    s = v.select(F.col("ordinal").cast("string").alias("story_id"), "source", "title", F.round(0.5 * importance_of(F.col("source_tier")) + 0.1, 4).alias("score"))
    return stories.penalised(s).select("story_id", "effective")


@query()
def title_similarities(spark: SparkSession, d: str) -> DataFrame:
    """Each title of the archive against the one that came just before in its source."""
    w = Window.partitionBy("source").orderBy("ordinal")
    a = table(spark, d, "archive_item").select("ordinal", titles.story_title(F.col("title")).alias("t"), "source").withColumn("o", F.lag("t").over(w)).where("o is not null")
    x, y = titles.tokens(F.col("t")), titles.tokens(F.col("o"))
    return a.select("ordinal", similarity("t", "o", F.when((F.size(x) > 0) & (F.size(y) > 0), titles.jaccard(x, y))).alias("similarity"))


# ---- statistics ----------------------------------------------------------------------------------------


@query(f"""
WITH raw AS (SELECT site_id, count(*) AS raw_count FROM archive_item GROUP BY site_id), v AS (SELECT site_id, count(*) AS n FROM {_VIEW} GROUP BY site_id)
SELECT raw.site_id, raw_count, coalesce(n, 0) AS count FROM raw LEFT JOIN v USING (site_id)""")
def stats_by_site(spark: SparkSession, d: str) -> DataFrame:
    return stats.site_stats(table(spark, d, "archive_item"), _viewed(spark, d)).select("site_id", "raw_count", "count")


@query("SELECT count(DISTINCT site_id || '::' || coalesce(source, '')) AS n_sources FROM archive_item")
def stats_sources(spark: SparkSession, d: str) -> DataFrame:
    return stats.source_count(table(spark, d, "archive_item"))


def _event_statuses(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").cast("string").alias("site_id"), (F.col("event_type") != "error").alias("ok"), (F.col("event_type") == "signup").alias("skipped"), (F.col("event_type") == "view").alias("replaced"),
        F.lit(1).alias("n_items"), F.col("event_id").alias("duration_ms"),
    )


@query("""
SELECT count(*) FILTER (event_type <> 'error') AS n_ok, count(*) FILTER (event_type = 'error') AS n_failed, count(*) FILTER (event_type = 'signup') AS n_skipped,
 count(*) FILTER (event_type = 'view') AS n_replaced, count(*) AS n_items, sum(event_id)::BIGINT AS duration_ms FROM events""")
def stats_rollup(spark: SparkSession, d: str) -> DataFrame:
    return stats.rollup(_event_statuses(spark, d))


@query("SELECT 'archive' AS part, site_id, count(*) AS n FROM archive_item GROUP BY site_id UNION ALL SELECT 'raw', site_id, count(*) FROM raw_item GROUP BY site_id")
def stats_union(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, f"{n}_item").select(F.lit(n).alias("part"), "site_id") for n in ("archive", "raw")]
    return parts[0].unionByName(parts[1]).groupBy("part", "site_id").agg(F.count("*").alias("n"))


# ---- blocks --------------------------------------------------------------------------------------------


@query("""
WITH RECURSIVE up AS (
 SELECT n_nationkey AS bid, n_nationkey - 1 AS pos, 1 AS hops FROM nation WHERE n_nationkey > 0
 UNION ALL SELECT bid, pos - 1, hops + 1 FROM up WHERE pos % 7 <> 0 AND pos > 0 AND hops < 20)
SELECT bid::VARCHAR AS bid, max(pos) AS mark FROM up WHERE pos % 7 = 0 GROUP BY bid""")
def block_ancestors(spark: SparkSession, d: str) -> DataFrame:
    """Nearest marked ancestor in a chain: every seventh nation is marked, each hangs below the one before."""
    n = table(spark, d, "nation")
    nodes = n.select(F.col("n_nationkey").cast("string").alias("bid"), F.when(F.col("n_nationkey") > 0, (F.col("n_nationkey") - 1).cast("string")).alias("parent_id"))
    marked = n.where("n_nationkey % 7 = 0").select(F.col("n_nationkey").cast("string").alias("bid"), F.col("n_nationkey").alias("mark"))
    return blocks.nearest_ancestor(nodes, marked)


# ---- captions ---------------------------------------------------------------------------------------------


def _cues(spark: SparkSession, d: str) -> DataFrame:
    return explode_cues(table(spark, d, "subtitles"))


@query("SELECT vtt_id, len(regexp_extract_all(vtt, '(?m)^(?:\\d+:)?\\d{1,2}:\\d{2}[.,]\\d{1,3} +-->'))::BIGINT AS n_cues FROM subtitles WHERE regexp_matches(vtt, '\\d +-->')")
def caption_counts(spark: SparkSession, d: str) -> DataFrame:
    return _cues(spark, d).groupBy("vtt_id").agg(F.count("*").alias("n_cues"))


@query()
def caption_cues(spark: SparkSession, d: str) -> DataFrame:
    return _cues(spark, d)


@query()
def caption_transcripts(spark: SparkSession, d: str) -> DataFrame:
    return captions.transcripts(captions.derolled(_cues(spark, d)))


@query("SELECT item_id, list_sort(list_distinct(list(lang))) AS langs, count(*) AS n_files FROM subtitles GROUP BY item_id")
def caption_coverage(spark: SparkSession, d: str) -> DataFrame:
    return captions.coverage(table(spark, d, "subtitles"))


@query()
def caption_speech_rate(spark: SparkSession, d: str) -> DataFrame:
    return captions.speech_rate(captions.derolled(_cues(spark, d)))


@query()
def caption_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return captions.overlaps(_cues(spark, d))


@query("SELECT a.ordinal, s.vtt_id FROM archive_item a JOIN subtitles s ON s.item_id = a.id")
def caption_of_archive(spark: SparkSession, d: str) -> DataFrame:
    a, s = table(spark, d, "archive_item"), table(spark, d, "subtitles")
    return a.select("ordinal", "id").join(s.select("vtt_id", "item_id"), F.col("id") == F.col("item_id")).select("ordinal", "vtt_id")


# ---- the whole pipeline ------------------------------------------------------------------------------------


@query()
def latest_payload(spark: SparkSession, d: str) -> DataFrame:
    """The display items of the window, redacted, the latest first: what the latest payload lists."""
    rows = items.latest_first(_items(spark, d))
    return titles.redact_all(rows.select("id", "site_id", "site_name", "source", "title", "url", times.iso(F.col("published_at")).alias("published_at"), "source_tier", "source_tier_label"))


