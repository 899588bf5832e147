"""Queries that render rows of the tables in the form a function, parser or sink takes, and read the result back.

Each has the SQL that says what must come out, over the same whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import feeds as rules
from newsloom.functions import times, titles, udf
from newsloom.functions.text import squeeze
from newsloom.operators import archive, blocks, captions, items, stats, stories, view
from newsloom.plans.reference import _EVENT, _IDENTITY, _NOW, _RANK, _TIER, _TOKENS, _VIEW, _WEIGHT, _WS, NOW, _cues, _norm, _viewed, registering
from newsloom.runtime import ranked, scratch, table
from newsloom.sinks import payloads
from newsloom.sources import composed, feeds, files

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
query = registering(_QUERIES, ORACLE)
TODAY = NOW.date()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def _pick(values: list[str], of: Column) -> Column:
    """One of the values, in turn."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(of, F.lit(len(values))) + 1).cast("int"))


def _sql_pick(values: list[str], of: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][{of} % {len(values)} + 1]"


# The characters of cp1252 between 0x80 and 0x9f, and their bytes.
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_HEX = "array_to_string(list_transform(string_split({t}, ''), lambda c: printf('%02x', unicode(c))), '')"
_DECODED = f"CASE WHEN NOT regexp_matches({{t}}, '[^\\x{{{{00}}}}-\\x{{{{ff}}}}]') THEN TRY(decode(unhex({_HEX}))) END"

#: SQL of a query that stands beside the others of its kind.
ORACLE["title_mojibake_undone"] = f"""
SELECT ordinal, coalesce(nullif(a, ''), nullif(b, '')) AS fixed FROM (SELECT ordinal, {_DECODED.format(t='title')} AS a, CASE WHEN NOT regexp_matches(title, '[\\x{{80}}-\\x{{9f}}]') THEN {_DECODED.format(t='w')} END AS b
 FROM (SELECT ordinal, title, translate(title, '{_CP1252}', {" || ".join(f"chr({b})" for b in _CP1252_BYTES)}) AS w FROM raw_item WHERE regexp_matches(title, '[ÃÂâ€]|[\\x{{80}}-\\x{{9f}}]|å|æ|ç')))
WHERE coalesce(nullif(a, ''), nullif(b, '')) IS NOT NULL"""
ORACLE["feed_bridges"] = "SELECT ordinal, NULL::VARCHAR AS bridge_type, NULL::VARCHAR AS bridge_kind, NULL::VARCHAR AS bridge_slug, NULL::VARCHAR AS url FROM feed_subscription"


# ---- functions on titles and texts -----------------------------------------------------------------

_BYTES = "array_to_string(list_transform(generate_series(1, length(hex(title)), 2), lambda i: chr(('0x' || substr(hex(title), i, 2))::INTEGER)), '')"


@query(f"SELECT ordinal, CASE WHEN regexp_matches(g, '[ÃÂâ€]|[\\x{{80}}-\\x{{9f}}]|å|æ|ç') THEN title ELSE g END AS fixed FROM (SELECT ordinal, title, {_BYTES} AS g FROM archive_item)")
def title_mojibake_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every title read as latin-1 on purpose, and undone where the signs show it."""
    garbled = F.decode(F.encode("title", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "archive_item").select("ordinal", udf.undo_mojibake(garbled).alias("fixed"))


@query("SELECT ordinal, coalesce(regexp_matches(title, 'Ã.|Â.|â€.|[\\x{80}-\\x{9f}]|\\x{fffd}'), false) AS noise FROM raw_item")
def title_noise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_item").select("ordinal", titles.has_noise(F.col("title")).alias("noise"))


_MAIL = "' Write to ed.' || ordinal || '@news.example.com or token=abcdef' || ordinal"
_SQUEEZED = f"trim(regexp_replace(title || {_MAIL} || '  ' || coalesce(summary, ''), '{_WS}+', ' ', 'g'))"
_REDACTED = (
    "regexp_replace(regexp_replace({t}, '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}\\b', '[redacted-email]', 'g'), "
    "'(?i)\\b(sk-[A-Za-z0-9_-]{{12,}}|(?:api[_-]?key|secret|token)=([^\\s&]{{6,}}))\\b', '[redacted-secret]', 'g')"
)


@query(f"SELECT ordinal, CASE WHEN length(s) <= 120 THEN s ELSE regexp_replace(substr(s, 1, 119), '{_WS}+$', '') || '…' END AS snippet FROM (SELECT ordinal, {_REDACTED.format(t=_SQUEEZED)} AS s FROM archive_item)")
def title_snippet(spark: SparkSession, d: str) -> DataFrame:
    mail = F.concat(F.lit(" Write to ed."), "ordinal", F.lit("@news.example.com or token=abcdef"), "ordinal")
    text = F.concat("title", mail, F.lit("  "), F.coalesce("summary", F.lit("")))
    return table(spark, d, "archive_item").select("ordinal", titles.snippet(text, 120).alias("snippet"))


@query("SELECT ordinal, trim(regexp_replace(replace(replace(title, '《', ''), '》', ''), '\\s+', ' ', 'g')) AS clean FROM archive_item")
def title_of_update(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("《"), "title", F.lit("》《 》"))
    return table(spark, d, "archive_item").select("ordinal", blocks.clean_title(t).alias("clean"))


@query(f"""
SELECT ordinal, CASE WHEN len(w) = 0 THEN 0.0 ELSE round_even(greatest(r, 0.6 * r + 0.4 * j), 4) END AS similarity
FROM (SELECT ordinal, w, 2.0 * length(t) / (2 * length(t) + 6) AS r, len(w) / (len(w) + 1.0) AS j FROM (SELECT ordinal, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t, {_TOKENS.format(t='title')} AS w FROM archive_item))""")
def title_similarity_of_longer(spark: SparkSession, d: str) -> DataFrame:
    """Each title against itself with one word more: the matching ratio and the word overlap are known."""
    a = table(spark, d, "archive_item").select("ordinal", titles.story_title(F.col("title")).alias("t")).withColumn("o", F.concat("t", F.lit(" qxzjv")))
    x, y = titles.tokens(F.col("t")), titles.tokens(F.col("o"))
    return a.select("ordinal", F.coalesce(udf.similarity("t", "o", F.when((F.size(x) > 0) & (F.size(y) > 0), titles.jaccard(x, y))), F.lit(0.0)).alias("similarity"))


_MODELS = ["GPT-4o", "gpt 5", "Claude Opus 3.5", "gemini-2.0", "llama  3", "DeepSeek-r1", "nothing", "grok 2", "Mistral-7b and GPT-4o"]


@query(f"""
SELECT ordinal, list_sort(list_distinct(list_transform(regexp_extract_all(lower(title || ' on ' || {_sql_pick(_MODELS, 'ordinal')}),
 '\\b(gpt[-\\s]?\\d+(?:\\.\\d+)?[a-z]*|claude(?:[-\\s]?(?:opus|sonnet|haiku))?[-\\s]?\\d+(?:\\.\\d+)?|gemini[-\\s]?\\d+(?:\\.\\d+)?|llama[-\\s]?\\d+(?:\\.\\d+)?|deepseek[-\\s]?[a-z0-9.]+|grok[-\\s]?\\d+(?:\\.\\d+)?|mistral[-\\s]?[a-z0-9.]+)\\b', 1),
 lambda m: regexp_replace(m, '\\s+', '-', 'g')))) AS models FROM archive_item""")
def title_models(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat("title", F.lit(" on "), _pick(_MODELS, F.col("ordinal")))
    return table(spark, d, "archive_item").select("ordinal", titles.models(t).alias("models"))


_VENDORS = ["OpenAI", "Claude", "Google DeepMind", "nobody", "hugging face", "Grok and OpenAI", "Anthropic"]
_VENDOR_SETS = "[['openai'], ['anthropic'], ['google'], [], ['huggingface'], ['openai', 'xai'], ['anthropic']]"


@query(f"""
WITH v AS (SELECT ordinal, {_VENDOR_SETS}[ordinal % 7 + 1] AS a, {_VENDOR_SETS}[(ordinal // 7) % 7 + 1] AS b FROM archive_item)
SELECT ordinal, len(a) = 0 OR len(b) = 0 OR list_has_any(a, b) AS compatible FROM v""")
def title_compatible(spark: SparkSession, d: str) -> DataFrame:
    """Sets that name vendors and share none may not be merged."""
    o = F.col("ordinal")
    a, b = titles.vendors(_pick(_VENDORS, o)), titles.vendors(_pick(_VENDORS, F.floor(o / 7)))
    return table(spark, d, "archive_item").select("ordinal", titles.compatible(a, b).alias("compatible"))


_PLACES = ["More", " 阅读全文 ", "read more", "查看详情", "", "A headline of its own", "more of it"]


@query(f"SELECT ordinal, lower(trim({_sql_pick(_PLACES, 'ordinal')})) IN ('', '阅读全文', '查看详情', 'more', 'read more') AS placeholder FROM archive_item")
def title_placeholders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "archive_item").select("ordinal", view.placeholder(_pick(_PLACES, F.col("ordinal"))).alias("placeholder"))


@query("SELECT ordinal, regexp_matches(lower(title || ' ' || coalesce(summary, '')), 'library|radio|bay|电台|数据') AS hit FROM archive_item")
def text_keywords(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat_ws(" ", "title", F.coalesce("summary", F.lit("")))
    return table(spark, d, "archive_item").select("ordinal", titles.contains_any(t, ["library", "radio", "bay", "电台", "数据"]).alias("hit"))


@query("SELECT ordinal, source || ' x' || ordinal || '@sub.news.example' AS mail, 'sub.news.example' AS domain, ['a.example', 'b-c.test'] AS domains, true AS below, ordinal % 2 = 0 AS allowed FROM feed_subscription_named".replace("feed_subscription_named", "(SELECT ordinal, title AS source FROM feed_subscription)"))
def mail_domains(spark: SparkSession, d: str) -> DataFrame:
    """Domain of an address with a name before it; a domain list; equality and subdomains."""
    mail = F.concat("title", F.lit(" x"), "ordinal", F.lit("@sub.news.example"))
    allowed = rules.domain_list(F.lit("b-c.test, @a.example  a.example,,not_a_domain"))
    host = F.when(F.col("ordinal") % 2 == 0, F.lit("www.a.example")).otherwise("xa.example")
    return table(spark, d, "feed_subscription").select(
        "ordinal", mail.alias("mail"), rules.mail_domain(mail).alias("domain"), allowed.alias("domains"), rules.domain_allowed(F.lit("x.b-c.test"), allowed).alias("below"), rules.domain_allowed(host, allowed).alias("allowed")
    )


_FEEDS = [
    *rules.REPLACEMENTS, *rules.SKIP_EXACT, *[p + "x/y" for p in rules.SKIP_PREFIXES], "https://kept.example/feed", " https://kept.example/with/space ", "",
]
_RESOLVED = [*rules.REPLACEMENTS.values(), *[""] * (len(rules.SKIP_EXACT) + len(rules.SKIP_PREFIXES)), "https://kept.example/feed", "https://kept.example/with/space", ""]
_REASONS = ["official_replacement"] * len(rules.REPLACEMENTS) + ["no_official_rss_or_unreachable"] * len(rules.SKIP_EXACT) + ["no_official_rss_for_source_type"] * len(rules.SKIP_PREFIXES) + ["", "", "empty_url"]


@query(f"SELECT ordinal, nullif({_sql_pick(_RESOLVED, 'ordinal')}, '') AS url, nullif({_sql_pick(_REASONS, 'ordinal')}, '') AS reason FROM feed_subscription")
def feed_rules(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of replacing and skipping, in turn."""
    r = rules.resolve(_pick(_FEEDS, F.col("ordinal")))
    return table(spark, d, "feed_subscription").withColumn("r", r).select("ordinal", "r.url", "r.reason")


_BRIDGED = [
    ("https://rsshub.app/telegram/channel/abc", "", "telegram", "", "abc", "https://t.me/s/abc"), ("https://rsshub.app/jike/topic/t9", "", "jike", "topic", "t9", "https://m.okjike.com/topics/t9"),
    ("https://rsshub.app/jike/user/u9", "", "jike", "user", "u9", "https://m.okjike.com/users/u9"), ("https://x.example/rss", "https://t.me/s/chan", "telegram", "", "chan", "https://t.me/s/chan"),
    ("https://x.example/rss", "https://m.okjike.com/users/me", "jike", "user", "me", "https://m.okjike.com/users/me"), ("https://x.example/rss", "https://x.example/", "", "", "", ""),
]


@query("SELECT ordinal, " + ", ".join(f"nullif({_sql_pick([b[k] for b in _BRIDGED], 'ordinal')}, '') AS {name}" for k, name in ((2, "bridge_type"), (3, "bridge_kind"), (4, "bridge_slug"), (5, "url"))) + " FROM feed_subscription")
def feed_bridged(spark: SparkSession, d: str) -> DataFrame:
    b = rules.bridge(_pick([x[0] for x in _BRIDGED], F.col("ordinal")), _pick([x[1] for x in _BRIDGED], F.col("ordinal")))
    return table(spark, d, "feed_subscription").withColumn("b", b).select("ordinal", "b.bridge_type", "b.bridge_kind", "b.bridge_slug", "b.url")


# ---- times -------------------------------------------------------------------------------------------


@query("SELECT ordinal, CASE ordinal % 5 WHEN 2 THEN epoch_us(t) // 1000 * 1000 WHEN 4 THEN NULL ELSE epoch_us(t) // 1000000 * 1000000 END AS micros FROM (SELECT ordinal, first_seen_at AS t FROM archive_item)")
def time_of_text(spark: SparkSession, d: str) -> DataFrame:
    """Instants written as ISO text, unix seconds, milliseconds and the twelve-hour form, read back; other text is null."""
    t, o = F.col("first_seen_at"), F.col("ordinal") % 5
    written = (
        F.when(o == 0, F.concat(F.lit("$D"), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"))).when(o == 1, F.unix_seconds(t).cast("string")).when(o == 2, F.unix_millis(t).cast("string"))
        .when(o == 3, F.concat(F.lit("at "), F.date_format(t, "yyyy-MM-dd h:mm:ssa"), F.lit(" UTC"))).otherwise("some day")
    )
    return table(spark, d, "archive_item").select("ordinal", F.unix_micros(times.parse(written)).alias("micros"))


@query("""
SELECT ordinal, year(t) AS y, month(t) AS m, month(t) AS m2, day(t) AS d,
 CASE WHEN make_date(2025, month(t), day(t)) > DATE '2025-11-14' THEN make_date(2024, month(t), day(t)) ELSE make_date(2025, month(t), day(t)) END::VARCHAR AS near
FROM (SELECT ordinal, timezone('UTC', first_seen_at) + ordinal % 300 * INTERVAL 1 DAY AS t FROM archive_item) WHERE NOT (month(t) = 2 AND day(t) = 29)""")
def time_of_headings(spark: SparkSession, d: str) -> DataFrame:
    t = F.timestamp_seconds(F.unix_seconds("first_seen_at") + F.col("ordinal") % 300 * 86400)
    ym, md = times.year_month(F.concat(F.year(t), F.lit(" 年 "), F.month(t), F.lit(" 月 更新"))), times.month_day(F.concat(F.lit("更新 "), F.month(t), F.lit("月"), F.dayofmonth(t), F.lit("日")))
    a = table(spark, d, "archive_item").withColumn("t", t).where(~((F.month("t") == 2) & (F.dayofmonth("t") == 29))).withColumns({"ym": ym, "md": md})
    near = times.date_near(F.col("md.month"), F.col("md.day"), TODAY)
    return a.select("ordinal", F.col("ym.year").alias("y"), F.col("ym.month").alias("m"), F.col("md.month").alias("m2"), F.col("md.day").alias("d"), near.cast("string").alias("near"))


# ---- view, items, stories ---------------------------------------------------------------------------


_ENGLISH = "trim(title) <> '' AND NOT regexp_matches(title, '[\\x{4e00}-\\x{9fff}]') AND length(regexp_replace(title, '[^A-Za-z]', '', 'g')) >= greatest(6, length(trim(title)) // 4)"


@query(f"""
WITH d AS (SELECT ordinal, title, {_norm('trim(url)', "{k} NOT LIKE 'utm\\_%' ESCAPE '\\' AND {k} NOT IN ('ref', 'spm', 'fbclid', 'gclid', 'igshid', 'mkt_tok', 'mc_cid', 'mc_eid', '_hsenc', '_hsmi')")} AS page,
 regexp_matches(title, '[\\x{{4e00}}-\\x{{9fff}}]') AS han, {_ENGLISH} AS english FROM archive_item),
 z AS (SELECT page, arg_max(title, ordinal) AS zh FROM d WHERE han GROUP BY page),
 c AS (SELECT title, max('译文' || ordinal) AS zh FROM d WHERE english AND ordinal % 3 = 0 GROUP BY title)
SELECT d.ordinal, CASE WHEN english AND coalesce(z.zh, c.zh) IS NOT NULL THEN coalesce(z.zh, c.zh) || ' / ' || d.title ELSE d.title END AS title_bilingual
FROM d LEFT JOIN z USING (page) LEFT JOIN c ON c.title = d.title""")
def view_bilingual_cached(spark: SparkSession, d: str) -> DataFrame:
    """Titles with a translation of the same page, else of the cache: every third English title is in it."""
    a = table(spark, d, "archive_item")
    cache = a.where(titles.mostly_english(F.col("title")) & (F.col("ordinal") % 3 == 0)).select("title", F.concat(F.lit("译文"), "ordinal").alias("title_zh"))
    return view.bilingual(a, cache).select("ordinal", "title_bilingual")


@query(f"""
SELECT ordinal, title AS title_original, title, CASE WHEN trim(source) <> '' THEN trim(source) ELSE regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') END AS source, {_TIER} AS source_tier FROM {_VIEW}""")
def view_displayed(spark: SparkSession, d: str) -> DataFrame:
    return view.displayed(_viewed(spark, d)).select("ordinal", "title_original", "title", "source", "source_tier")


@query(f"SELECT ordinal, row_number() OVER (ORDER BY event_at DESC NULLS LAST, ordinal) AS place FROM (SELECT ordinal, {_EVENT} AS event_at FROM archive_item)")
def items_in_order(spark: SparkSession, d: str) -> DataFrame:
    return ranked(items.latest_first(view.with_event_time(table(spark, d, "archive_item"))), "place").select("ordinal", "place")


@query("SELECT ordinal, row_number() OVER (ORDER BY last_seen_at DESC NULLS LAST, ordinal) AS place FROM archive_item")
def archive_in_order(spark: SparkSession, d: str) -> DataFrame:
    return ranked(archive.latest_first(table(spark, d, "archive_item")), "place").select("ordinal", "place")


_PAGES = f"""
v AS (SELECT *, {_norm('trim(url)', _IDENTITY)} AS page, {_TIER} AS t FROM {_VIEW}),
c AS (SELECT page, count(*) AS n, max(event_at) AS e1 FROM v GROUP BY page),
s AS (SELECT v.*, c.n, c.e1, {_WEIGHT.format(t='t')}::DOUBLE AS w, CASE WHEN event_at IS NULL THEN 0 ELSE greatest(0, least(1, (24 - greatest(0, (epoch_us({_NOW}) - epoch_us(event_at)) / 3600000000.0)) / 24)) END AS r,
 least(1, greatest(0, (c.n - 1) / 4.0)) AS h, {_RANK.format(t='t')} AS k FROM v JOIN c USING (page)),
x AS (SELECT *, round(greatest(0, least(1, 0.5 * w + 0.3 * r + 0.2 * h)), 4) AS score FROM s),
p AS (SELECT *, 'story_' || substr(sha1(page), 1, 12) AS story_id FROM x QUALIFY row_number() OVER (PARTITION BY page ORDER BY k, score DESC, epoch_us(event_at) DESC, title, ordinal) = 1)"""


def _page_stories(spark: SparkSession, d: str) -> DataFrame:
    from newsloom.functions import ids

    v = _viewed(spark, d)
    return stories.records(v, v.select("id", "ordinal", ids.story_id(F.col("url"), F.col("title"), F.col("id")).alias("story_id")), NOW)


@query(f"""
WITH {_PAGES}, n AS (SELECT page, list_sort(list(DISTINCT coalesce(nullif(source, ''), nullif(site_name, '')))) AS names FROM v GROUP BY page),
 y AS (SELECT *, CASE WHEN t = 'official' THEN 'official' WHEN n >= 3 THEN 'multi_source' WHEN score >= 0.72 THEN 'industry' ELSE 'watch' END AS category FROM p)
SELECT story_id, title, url, source, n AS source_count, n AS duplicate_count, array_to_string(names, '|') AS names, category,
 CASE category WHEN 'official' THEN '官方更新' WHEN 'multi_source' THEN '多源热议' WHEN 'industry' THEN '行业动态' ELSE '值得关注' END AS importance_label,
 round(w, 4) AS source_tier, round(r, 4)::DOUBLE AS recency, round(h, 4)::DOUBLE AS story_heat, id AS primary_id,
 CASE WHEN t <> 'official' AND n < 2 AND score < 0.75 THEN 'recent_ai_signal' ELSE concat_ws('|', CASE WHEN t = 'official' THEN 'official_source' END, CASE WHEN n >= 2 THEN 'multi_source' END, CASE WHEN score >= 0.75 THEN 'high_importance' END) END AS reasons
FROM y JOIN n USING (page)""")
def story_page_records(spark: SparkSession, d: str) -> DataFrame:
    """Whole records of the stories by page: category, label, reasons, breakdown, names, primary item."""
    r = _page_stories(spark, d)
    return r.select(
        "story_id", "title", "url", "source", "source_count", "duplicate_count", F.array_join("source_names", "|").alias("names"), "category", "importance_label",
        *[F.col(f"importance_breakdown.{c}").alias(c) for c in ("source_tier", "recency", "story_heat")], F.col("primary_item.id").alias("primary_id"), F.array_join("reasons", "|").alias("reasons"),
    )


@query(f"WITH {_PAGES} SELECT 'story_' || substr(sha1(page), 1, 12) AS story_id, row_number() OVER (PARTITION BY page ORDER BY k, coalesce(epoch_us(event_at), 0) DESC, title, ordinal) AS place, id, title, url, source, site_name AS source_name, site_id, epoch_us(published_at) AS published FROM x")
def story_page_links(spark: SparkSession, d: str) -> DataFrame:
    """The items of each story, in order of tier, time and title."""
    link = _page_stories(spark, d).select("story_id", F.posexplode("items").alias("p", "i"))
    return link.select("story_id", (F.col("p") + 1).cast("long").alias("place"), *[F.col(f"i.{c}").alias(c) for c in ("id", "title", "url", "source", "source_name", "site_id")], F.unix_micros("i.published_at").alias("published"))


@query(f"WITH {_PAGES} SELECT story_id, row_number() OVER (ORDER BY score DESC, e1 NULLS FIRST, title, story_id) AS place FROM p")
def story_pages_in_order(spark: SparkSession, d: str) -> DataFrame:
    return ranked(stories.in_order(_page_stories(spark, d)), "place").select("story_id", "place")


@query(f"WITH {_PAGES} SELECT story_id FROM p WHERE n >= 2 OR score >= 0.72")
def story_pages_gated(spark: SparkSession, d: str) -> DataFrame:
    return stories.gated(_page_stories(spark, d)).select("story_id")


_SCORED = "SELECT c_custkey, c_mktsegment AS source, c_name AS title, 0.5 + (c_custkey * 7919 % 5003) / 10000.0 AS score FROM customer"


@query(f"""
WITH s AS ({_SCORED}), g AS (SELECT *, score - 0.03 * (row_number() OVER (PARTITION BY source ORDER BY score DESC, title) - 1) AS effective FROM s WHERE score >= 0.72)
SELECT row_number() OVER (ORDER BY effective DESC, score DESC, title)::INTEGER AS rank, 'c' || c_custkey AS story_id FROM g ORDER BY rank LIMIT 20""")
def story_brief_penalised(spark: SparkSession, d: str) -> DataFrame:
    """The greedy brief over stories whose titles are too short to repeat each other: then penalties alone decide."""
    c = table(spark, d, "customer")
    score = F.lit(0.5) + F.pmod(F.col("c_custkey") * 7919, F.lit(5003)) / 10000.0
    s = c.select(F.concat(F.lit("c"), "c_custkey").alias("story_id"), F.col("c_mktsegment").alias("source"), F.lit("").alias("source_name"), F.col("c_name").alias("title"), score.alias("score"), F.lit(1).alias("source_count"))
    return stories.brief(s)


@query(f"""
WITH {_PAGES}, f AS (SELECT page, arg_min(ordinal, struct_pack(a := coalesce(epoch_us(event_at), -4611686018427387904), b := ordinal)) AS head FROM v GROUP BY page)
SELECT 'story_' || substr(sha1(page), 1, 12) AS story_id, v.id AS item_id, 'canonical_url' AS reason FROM v JOIN f USING (page) WHERE v.ordinal <> f.head""")
def story_page_events(spark: SparkSession, d: str) -> DataFrame:
    """What is merged by page alone: titles are made short, so that none is compared."""
    v = _viewed(spark, d).withColumn("title", F.concat(F.lit("t"), F.col("ordinal")))
    e = stories.merge_events(stories.merged(v))
    return e.select("story_id", "item_id", "reason")


#: Each title against itself with one word more behind it: matching ratio and word overlap are known.
_DOUBLED = f"""(SELECT *, len(w) + 1 >= 4 AND length(t) + 6 >= 18 AS mergeable, round_even(greatest(r, 0.6 * r + 0.4 * j), 4) AS sim FROM (SELECT ordinal, w, t, 2.0 * length(t) / (2 * length(t) + 6) AS r, len(w) / (len(w) + 1.0) AS j
 FROM (SELECT ordinal, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS t, {_TOKENS.format(t='title')} AS w FROM archive_item)))"""


def _doubled(spark: SparkSession, d: str, hours: int) -> DataFrame:
    """The archive's titles far apart in time, and each once more an hour later with a word behind it."""
    a = table(spark, d, "archive_item").select("ordinal", "title")
    twice = a.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    at = F.timestamp_seconds(F.lit(1_000_000_000) + F.col("ordinal") * hours * 3600 + F.col("copy") * 3600)
    title = F.when(F.col("copy") == 1, F.concat("title", F.lit(" qxzjv"))).otherwise(F.col("title"))
    key = F.concat("ordinal", F.lit("-"), "copy")
    return twice.select(key.alias("id"), (F.col("ordinal") * 2 + F.col("copy")).alias("ordinal"), F.concat(F.lit("s"), "ordinal").alias("site_id"), title.alias("title"), F.concat(F.lit("https://x.example/"), key).alias("url"), at.alias("event_at"), F.lit(3).alias("source_tier_rank"))


@query(f"SELECT ordinal || '-1' AS id FROM {_DOUBLED} WHERE mergeable AND len(w) > 0 AND j >= 0.5 AND sim >= 0.9")
def items_near_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Near repeats where every site has two items, the later with one word more."""
    return items.near_repeats(_doubled(spark, d, 24))


@query(f"SELECT ordinal * 2 + c AS ordinal, CASE WHEN c = 1 AND hit THEN 'title_similarity' ELSE 'founder' END AS reason, CASE WHEN c = 1 AND hit THEN sim ELSE 1.0 END AS similarity FROM (SELECT *, mergeable AND len(w) > 0 AND sim >= 0.86 AS hit, unnest([0, 1]) AS c FROM {_DOUBLED})")
def story_title_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Stories merged by title, where every title has one other near it in time: itself with a word more."""
    return stories.merged(_doubled(spark, d, 24)).select("ordinal", "reason", "similarity")


@query(f"""
WITH t AS (SELECT min(ordinal) AS ordinal, arg_min(title, ordinal) AS title FROM archive_item WHERE regexp_matches(title, '^[A-Za-z ]+$') AND len({_TOKENS.format(t='title')}) >= 6 GROUP BY list_sort({_TOKENS.format(t='title')})[1:3]),
 s AS (SELECT 'a' || ordinal AS story_id, 0.8 + (ordinal * 7919 % 100003) / 1000000.0 AS score, title FROM t)
SELECT row_number() OVER (ORDER BY score DESC, title)::INTEGER AS rank, story_id FROM s ORDER BY rank LIMIT 20""")
def story_brief_without_repeats(spark: SparkSession, d: str) -> DataFrame:
    """The brief over stories of which each comes twice, the second a little lower and with a word more: it must not be picked."""
    words = F.array_sort(titles.tokens(F.col("title")))
    a = table(spark, d, "archive_item").where(F.col("title").rlike("^[A-Za-z ]+$") & (F.size(words) >= 6))
    t = a.groupBy(F.slice(words, 1, 3).alias("w")).agg(F.min("ordinal").alias("ordinal"), F.min_by("title", "ordinal").alias("title"))
    twice = t.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    score = F.lit(0.8) + F.pmod(F.col("ordinal") * 7919, F.lit(100003)) / 1000000.0 - F.col("copy") * 1e-9
    return stories.brief(twice.select(
        F.concat(F.when(F.col("copy") == 1, "b").otherwise("a"), "ordinal").alias("story_id"), F.concat("ordinal", F.lit("-"), "copy").alias("source"), F.lit("").alias("source_name"),
        F.when(F.col("copy") == 1, F.concat("title", F.lit(" qxzjv"))).otherwise(F.col("title")).alias("title"), score.alias("score"), F.lit(2).alias("source_count"),
    ))


# ---- statistics ----------------------------------------------------------------------------------------


@query("SELECT list_sort(list(DISTINCT user_id::VARCHAR) FILTER (event_type = 'error')) AS failed, list_sort(list(DISTINCT user_id::VARCHAR) FILTER (event_type <> 'error' AND event_id % 3 = 0)) AS empty FROM events")
def stats_failed_and_empty(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("site_id"), (F.col("event_type") != "error").alias("ok"), (F.col("event_id") % 3).alias("n_items"))
    return stats.failed_and_empty(e)


@query(f"SELECT (SELECT count(*) FROM {_VIEW}) AS total_items, count(DISTINCT {_norm('trim(url)', _IDENTITY)}) AS total_stories FROM {_VIEW}")
def stats_totals(spark: SparkSession, d: str) -> DataFrame:
    return stats.totals(_viewed(spark, d), _page_stories(spark, d))


@query(f"SELECT site_id, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, site_id) AS place FROM {_VIEW} GROUP BY site_id")
def stats_sites_in_order(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of the latest payload, most items first."""
    s = payloads.latest(_viewed(spark, d), NOW, 24).select(F.posexplode("site_stats").alias("p", "s"))
    return s.select("s.site_id", "s.count", (F.col("p") + 1).cast("long").alias("place"))


# ---- blocks --------------------------------------------------------------------------------------------


def _page_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A page of blocks: a month heading, below it the days of the clock of the archive, below these the titles."""
    a = table(spark, d, "archive_item").withColumn("day", F.to_date("first_seen_at"))
    days, months = a.select("day").distinct(), a.select(F.trunc("day", "month").alias("m")).distinct()

    def rows(df: DataFrame, order: Column, bid: Column, parent: Column, kind: str, text: Column) -> DataFrame:
        return df.select(order.cast("long").alias("ordinal"), bid.alias("bid"), parent.alias("parent_id"), F.lit(kind).alias("type"), text.alias("text"))

    m, none = F.date_format("m", "yyyy-MM"), F.lit("root")
    heads = rows(months, F.month("m"), m, none, "heading2", F.concat(F.year("m"), F.lit("年"), F.month("m"), F.lit("月")))
    dated = rows(days, F.unix_date("day"), F.date_format("day", "yyyy-MM-dd"), F.date_format("day", "yyyy-MM"), "heading3", F.concat(F.month("day"), F.lit("月"), F.dayofmonth("day"), F.lit("日")))
    entries = rows(a, F.col("ordinal") + 100_000, F.concat(F.lit("e"), "ordinal"), F.date_format("day", "yyyy-MM-dd"), "bullet", F.concat(F.lit("《"), "title", F.lit("》")))
    return heads.unionByName(dated).unionByName(entries)


_UPDATES = "SELECT DISTINCT strftime(first_seen_at, '%Y-%m-%d') AS date, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title FROM archive_item"


@query(f"SELECT *, 'https://page.example/' AS url FROM ({_UPDATES})")
def block_updates(spark: SparkSession, d: str) -> DataFrame:
    found = blocks.updates(_page_blocks(spark, d), TODAY, "https://page.example/")
    return found.select(F.col("date").cast("string").alias("date"), "title", "url")


@query(f"SELECT date, title, row_number() OVER (ORDER BY date DESC, title DESC) AS place FROM ({_UPDATES}) WHERE date BETWEEN '2025-11-06' AND '2025-11-12'")
def block_last_week(spark: SparkSession, d: str) -> DataFrame:
    week = blocks.last_week(blocks.updates(_page_blocks(spark, d), TODAY, "u"), TODAY)
    return ranked(week, "place").select(F.col("date").cast("string").alias("date"), "title", "place")


@query(f"WITH u AS ({_UPDATES}) SELECT max(date) AS latest_date, count(*) FILTER (date = (SELECT max(date) FROM u)) AS n_latest, count(*) AS n_all FROM u")
def block_digest(spark: SparkSession, d: str) -> DataFrame:
    g = blocks.digest(blocks.updates(_page_blocks(spark, d), TODAY, "u"))
    return g.select(F.col("latest_date").cast("string").alias("latest_date"), "n_latest", "n_all")


@query("SELECT ordinal, substr(title, 1, 2) || substr(title, 3, 2) || substr(title, 5) AS text FROM archive_item")
def block_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts in pieces whose numbers, not their order in the map, tell how they go together."""
    pieces = F.create_map(F.lit("10"), F.substring("title", 5, 1 << 20), F.lit("2"), F.substring("title", 3, 2), F.lit("0"), F.substring("title", 1, 2))
    return table(spark, d, "archive_item").select("ordinal", blocks.block_text(pieces).alias("text"))


# ---- captions ------------------------------------------------------------------------------------------

_TIME = "(?:(\\d+):)?(\\d{1,2}):(\\d{2})[.,](\\d{1,3})"
_TIMING = f"^\\s*{_TIME}\\s*-->\\s*{_TIME}(.*)$"


def _ms_sql(g: int) -> str:
    def part(k: int) -> str:
        return f"regexp_extract(line, '{_TIMING}', {k})"

    return f"(coalesce(nullif({part(g)}, '')::BIGINT, 0) * 3600000 + {part(g + 1)}::BIGINT * 60000 + {part(g + 2)}::BIGINT * 1000 + rpad({part(g + 3)}, 3, '0')::BIGINT)"


#: Cues of every file from its lines: a line belongs to the last timing line before it, unless an empty line is between.
_CUE_SQL = f"""
f AS (SELECT vtt_id, item_id, lang, string_split(regexp_replace(vtt, '\\r\\n|\\r', chr(10), 'g'), chr(10)) AS ls FROM subtitles WHERE vtt IS NOT NULL),
l AS (SELECT vtt_id, item_id, lang, unnest(ls) AS line, generate_subscripts(ls, 1) AS n FROM f),
t AS (SELECT *, contains(line, '-->') AND regexp_matches(line, '{_TIMING}') AS timing FROM l),
k AS (SELECT *, count(*) FILTER (timing) OVER w AS cue_no, max(CASE WHEN timing THEN n END) OVER w AS began, max(CASE WHEN NOT timing AND line = '' THEN n END) OVER w AS gap FROM t WINDOW w AS (PARTITION BY vtt_id ORDER BY n)),
h AS (SELECT vtt_id, item_id, lang, cue_no, {_ms_sql(1)} AS start_ms, {_ms_sql(5)} AS end_ms, trim(regexp_extract(line, '{_TIMING}', 9)) AS settings FROM k WHERE timing),
x AS (SELECT vtt_id, cue_no, string_agg(replace(replace(replace(regexp_replace(line, '<[^<>]*>', '', 'g'), '&nbsp;', ' '), '&gt;', '>'), chr(160), ' '), chr(10) ORDER BY n) AS text
 FROM k WHERE NOT timing AND cue_no > 0 AND line <> '' AND coalesce(gap, 0) < began GROUP BY vtt_id, cue_no),
cue AS (SELECT h.*, coalesce(x.text, '') AS text FROM h LEFT JOIN x USING (vtt_id, cue_no))"""
_ROLLED_SQL = f"""{_CUE_SQL},
r AS (SELECT *, list_filter(string_split(text, chr(10)), lambda y: trim(y) <> '') AS ys FROM cue),
b AS (SELECT *, lag(ys) OVER (PARTITION BY vtt_id ORDER BY start_ms, cue_no) AS py FROM r),
e AS (SELECT vtt_id, item_id, lang, cue_no, start_ms, end_ms, array_to_string(CASE WHEN contains(settings, 'position:0%') AND len(ys) > 0 AND ys[1] = py[len(py)] THEN ys[2:] ELSE ys END, chr(10)) AS text FROM b),
de AS (SELECT * FROM e WHERE text <> '')"""


def _squeezed(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}+', ' ', 'g'))"


@query(f"WITH {_ROLLED_SQL} SELECT vtt_id, cue_no::INTEGER AS cue_no, text FROM de")
def caption_derolled(spark: SparkSession, d: str) -> DataFrame:
    return captions.derolled(_cues(spark, d)).select("vtt_id", "cue_no", "text")


#: SQL of queries that stand beside the others of their kind.
ORACLE |= {
    "caption_cues": f"WITH {_CUE_SQL} SELECT vtt_id, item_id, lang, cue_no::INTEGER AS cue_no, start_ms, end_ms, settings, text FROM cue",
    "caption_transcripts": f"WITH {_ROLLED_SQL} SELECT vtt_id, item_id, lang, count(*) AS n_cues, {_squeezed('string_agg(text, chr(32) ORDER BY start_ms, cue_no)')} AS text FROM de GROUP BY vtt_id, item_id, lang",
    "caption_speech_rate": f"WITH {_ROLLED_SQL} SELECT vtt_id, start_ms // 60000 AS minute, sum(len(list_filter(string_split({_squeezed('text')}, ' '), lambda w: w <> '')))::BIGINT AS n_words, count(*) AS n_cues FROM de GROUP BY 1, 2",
    "caption_overlaps": f"WITH {_CUE_SQL}, o AS (SELECT vtt_id, start_ms < lag(end_ms) OVER (PARTITION BY vtt_id ORDER BY cue_no) AS over_ FROM cue) SELECT vtt_id, count(*) FILTER (over_) AS n_overlaps FROM o GROUP BY vtt_id",
}


# ---- sources: rows written as documents, and parsed --------------------------------------------------


def _xml(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def _documents(rows: DataFrame, piece: Column, kind: str, head: str = "", tail: str = "", between: str = "\n", by: str = "source") -> DataFrame:
    """One document for each value of ``by``, made of a piece a row."""
    group = rows.select(F.col(by).alias("source"), "ordinal", piece.alias("piece")).groupBy("source")
    body = F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "piece"))), lambda p: p["piece"]), between), F.lit(tail))
    d = group.agg(F.min("ordinal").alias("doc_no"), body.alias("body"))
    return d.select("doc_no", F.lit(kind).alias("kind"), F.lit("site").alias("site_id"), F.lit("Site").alias("site_name"), "source", "body")


def _parsed(spark: SparkSession, docs: DataFrame, *columns: str) -> DataFrame:
    found = feeds.items(feeds.scan(docs, NOW))
    return found.select("title", "url", F.floor(F.unix_micros("published_at") / 1_000_000).alias("seconds"), *columns).distinct()


def _json(**values: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in values.items()]))




def _seen() -> Column:
    return F.date_format("first_seen_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _rfc() -> Column:
    return F.concat(F.date_format("first_seen_at", "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


_TITLE = "trim(regexp_replace(title, '\\s+', ' ', 'g'))"
_SECONDS = "epoch_us(first_seen_at) // 1000000 AS seconds"
_FRESH = f"first_seen_at >= {_NOW} - INTERVAL 21 DAY"


@query("SELECT title, category, xml_url, coalesce(html_url, '') AS html_url FROM feed_subscription WHERE xml_url <> '' QUALIFY row_number() OVER (PARTITION BY xml_url ORDER BY ordinal) = 1")
def source_opml(spark: SparkSession, d: str) -> DataFrame:
    """The subscriptions as an outline two levels deep, written and read."""
    f = table(spark, d, "feed_subscription")
    line = F.concat(F.lit('<outline text="x" title="'), _xml(F.col("title")), F.lit('" category="'), _xml(F.col("category")), F.lit('" xmlUrl="'), _xml(F.col("xml_url")), F.lit('" htmlUrl="'), _xml(F.coalesce("html_url", F.lit(""))), F.lit('"/>'))
    path = scratch(spark, "opml")
    _documents(f.withColumn("one", F.lit("all")), line, "opml", '<opml version="2.0"><body><outline text="all">', "</outline></body></opml>", by="one").select("body").coalesce(1).write.text(path, lineSep="\n")
    return files.read_opml(spark, f"{path}/*.txt").select("title", "category", "xml_url", "html_url")


@query("SELECT DISTINCT title, url, epoch_us(published_at) // 1000000 AS seconds FROM archive_item WHERE trim(title) <> '' AND published_at IS NOT NULL".replace("title, url", "trim(title) AS title, trim(url) AS url") + " QUALIFY row_number() OVER (PARTITION BY source, trim(title), trim(url) ORDER BY ordinal) = 1")
def source_rss(spark: SparkSession, d: str) -> DataFrame:
    """Archive rows as RSS, a feed a source; only dated items stay, the first of each title and link."""
    a = table(spark, d, "archive_item").where("published_at is not null")
    date = F.concat(F.date_format("published_at", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    item = F.concat(F.lit("<item><title>"), _xml(F.col("title")), F.lit("</title><link>"), _xml(F.col("url")), F.lit("</link><pubDate>"), date, F.lit("</pubDate></item>"))
    return _parsed(spark, _documents(a, item, "xml", "<rss><channel>", "</channel></rss>"))


@query("SELECT DISTINCT trim(title) AS title, trim(url) AS url, epoch_us(first_seen_at) // 1000000 AS seconds FROM archive_item WHERE trim(title) <> '' QUALIFY row_number() OVER (PARTITION BY source, trim(title), trim(url) ORDER BY ordinal) = 1")
def source_atom(spark: SparkSession, d: str) -> DataFrame:
    item = F.concat(F.lit("<entry><title>"), _xml(F.col("title")), F.lit('</title><link href="'), _xml(F.col("url")), F.lit('"/><updated>'), _seen(), F.lit("</updated></entry>"))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), item, "xml", '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>"))


@query(f"SELECT DISTINCT CASE WHEN length(t) <= 96 THEN t ELSE rtrim(substr(t, 1, 95)) || '…' END AS title, 'https://t.me/c/' || ordinal AS url, {_SECONDS} FROM (SELECT *, {_TITLE} AS t FROM archive_item) WHERE t <> ''")
def source_channel(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.lit('<div class="tgme_widget_message" data-post="c/'), "ordinal", F.lit('"><div class="tgme_widget_message_text">'), _xml(F.col("title")), F.lit('</div><time datetime="'), _seen(), F.lit('">x</time></div>'))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "telegram"))


@query(f"SELECT DISTINCT CASE WHEN length(t) <= 96 THEN t ELSE rtrim(substr(t, 1, 95)) || '…' END AS title, 'https://m.okjike.com/originalPosts/p' || ordinal AS url, {_SECONDS} FROM (SELECT *, {_TITLE} AS t FROM archive_item) WHERE t <> ''")
def source_posts(spark: SparkSession, d: str) -> DataFrame:
    piece = _json(id=F.concat(F.lit("p"), "ordinal"), content=F.col("title"), createdAt=_seen())
    docs = _documents(table(spark, d, "archive_item"), piece, "jike", '<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"posts":[', "]}}}</script></html>", ",")
    return _parsed(spark, docs)


@query(f"SELECT DISTINCT {_TITLE} AS title, url, {_SECONDS}, source || ' · second' AS source FROM archive_item WHERE trim(title) <> ''")
def source_publishers(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.lit('<div class="publisher-link"><a class="article-link" href="'), _xml(F.col("url")), F.lit('">'), _xml(F.col("title")), F.lit('</a><span class="publisher-name">second</span><time datetime="'), _seen(), F.lit('"></time></div>'))
    head = F.concat(F.lit('<span class="primary">'), _xml(F.col("source")), F.lit("</span>"))
    a = table(spark, d, "archive_item").withColumn("piece", F.concat(F.lit('<div class="publisher-block">'), head, piece, F.lit("</div>")))
    return _parsed(spark, _documents(a, F.col("piece"), "publishers"), "source")


@query(f"SELECT DISTINCT trim(title) AS title, trim(url) AS url, {_SECONDS}, CASE WHEN trim(site_name) <> '' THEN trim(site_name) ELSE source END AS source FROM archive_item WHERE trim(title) <> ''")
def source_json_feed(spark: SparkSession, d: str) -> DataFrame:
    piece = _json(title=F.col("title"), url=F.col("url"), source=F.lit(" "), site_name=F.col("site_name"), channel=F.col("source"), date_published=_seen())
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "json", '{"items":[', "]}", ","), "source")


@query(f"SELECT DISTINCT trim(title) AS title, trim(url) AS url, CASE WHEN ordinal % 2 = 0 THEN epoch_us(first_seen_at) // 1000000 ELSE epoch_us({_NOW}) // 1000000 END AS seconds FROM archive_item WHERE trim(title) <> ''")
def source_hot_list(spark: SparkSession, d: str) -> DataFrame:
    piece = _json(title=F.col("title"), url=F.col("url"), time=F.when(F.col("ordinal") % 2 == 0, F.unix_seconds("first_seen_at")))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "hot", '{"posts":[', "]}", ","))


@query(f"SELECT {_TITLE} AS title, 'https://v.example/news/' || ordinal AS url, {_SECONDS} FROM archive_item WHERE trim(title) <> '' AND {_FRESH}")
def source_news_page(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.lit('<a href="https://v.example/news/'), "ordinal", F.lit('"><h3>'), _xml(F.col("title")), F.lit('</h3><time datetime="'), _seen(), F.lit('"></time></a><a href="/about"><h3>No news</h3><time datetime="'), _seen(), F.lit('"></time></a>'))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "news"))


@query(f"SELECT {_TITLE} AS title, '#e' || ordinal AS url, {_SECONDS} FROM archive_item WHERE trim(title) <> '' AND {_FRESH}")
def source_changelog(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.lit('<li id="e'), "ordinal", F.lit('"><time>'), _rfc(), F.lit("</time><h3>"), _xml(F.col("title")), F.lit("</h3></li>"))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "changelog", "<ul>", "</ul>"))


@query(f"SELECT DISTINCT trim(title) AS title, trim(url) AS url, {_SECONDS} FROM (SELECT * FROM archive_item QUALIFY row_number() OVER (PARTITION BY source, trim(title), trim(url) ORDER BY ordinal) = 1) WHERE trim(title) <> '' AND {_FRESH} AND (contains(lower(title || ' ' || url), 'radio') OR contains(lower(title || ' ' || url), 'p/1'))")
def source_official(spark: SparkSession, d: str) -> DataFrame:
    """Feeds of which an item must name a keyword and be fresh."""
    item = F.concat(F.lit("<item><title>"), _xml(F.col("title")), F.lit("</title><link>"), _xml(F.col("url")), F.lit("</link><pubDate>"), _rfc(), F.lit("</pubDate></item>"))
    docs = _documents(table(spark, d, "archive_item"), item, "official", "<rss><channel>", "</channel></rss>").withColumn("keywords", F.array(F.lit("radio"), F.lit("p/1")))
    return _parsed(spark, docs)


@query(f"SELECT {_TITLE} AS title, 'https://n.example/p/' || ordinal AS url, epoch_us(date_trunc('day', first_seen_at)) // 1000000 AS seconds FROM archive_item WHERE trim(title) <> '' AND NOT contains(title, '*') AND date_trunc('day', first_seen_at) >= {_NOW} - INTERVAL 21 DAY")
def source_markdown(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.date_format("first_seen_at", "MMM d, yyyy"), F.lit(" • 5 min read\n\n### **"), F.col("title"), F.lit("** more text](https://n.example/p/"), "ordinal", F.lit(")"))
    return _parsed(spark, _documents(table(spark, d, "archive_item").where("title not like '%*%' and trim(title) <> ''"), piece, "markdown"))


@query(f"SELECT title, url, epoch_us(TIMESTAMPTZ '2025-11-10 00:00:00+00') // 1000000 AS seconds FROM (SELECT {_TITLE} AS title, 'https://d.example/p/' || ordinal AS url FROM archive_item) WHERE length(title) >= 5")
def source_daily(spark: SparkSession, d: str) -> DataFrame:
    """One issue: a third of the items bold in a list, a third with a generic link text beside bold text, a third as links of the article; links beside the article don't count."""
    href, o = F.concat(F.lit("https://d.example/p/"), "ordinal"), F.col("ordinal") % 3
    bold = F.concat(F.lit("<strong>"), _xml(F.col("title")), F.lit("</strong>"))
    piece = (
        F.when(o == 0, F.concat(F.lit('<ul><li><p>'), bold, F.lit('<a href="'), href, F.lit('?utm_source=x">go</a></p></li></ul><a target="_blank" href="'), href, F.lit('#again">Seen before</a>')))
        .when(o == 1, F.concat(F.lit("<p>"), bold, F.lit('<a target="_blank" href="'), href, F.lit('">阅读全文</a></p>')))
        .otherwise(F.concat(F.lit('<a href="'), href, F.lit('">'), _xml(F.col("title")), F.lit("</a>")))
    )
    head = '<body><h1>AI资讯日报 2025/11/10</h1><a href="https://elsewhere.example/">Not of the issue</a><article><div class="content">'
    long = table(spark, d, "archive_item").where(F.length(squeeze(F.col("title"))) >= 5)
    found = _parsed(spark, _documents(long, piece, "daily", head, "</div></article></body>"))
    return found.withColumn("url", F.regexp_replace("url", r"\?utm_source=x$", ""))


@query(f"SELECT {_TITLE} AS title, 'https://h.example/' || ordinal AS url, NULL::BIGINT AS seconds FROM archive_item WHERE trim(title) <> ''")
def source_headings(spark: SparkSession, d: str) -> DataFrame:
    piece = F.concat(F.lit('<a href="https://h.example/'), "ordinal", F.lit('"><h3>'), _xml(F.col("title")), F.lit("</h3></a>"))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "headings"))


@query(f"SELECT DISTINCT trim(title) AS title, trim(url) AS url, CASE ordinal % 3 WHEN 2 THEN epoch_us({_NOW}) // 1000000 ELSE epoch_us(first_seen_at) // 1000000 END AS seconds, source || ' (s' || ordinal % 3 || ')' AS source FROM archive_item WHERE trim(title) <> ''")
def source_aggregated(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of one item each: dated by the item, by its extra field, or not at all."""
    o = F.col("ordinal") % 3
    i = F.struct(F.col("title").alias("title"), F.col("url").alias("url"), F.when(o == 0, F.unix_millis("first_seen_at")).alias("pubDate"), F.struct(F.when(o == 1, _seen()).alias("date")).alias("extra"))
    piece = _json(id=F.concat(F.lit("s"), o), title=F.col("source"), items=F.array(i))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "aggregated", '{"data":[', "]}", ","), "source")


@query(f"SELECT trim(title) AS title, '/' || ordinal AS url, {_SECONDS} FROM archive_item WHERE trim(title) <> ''")
def source_newsletter(spark: SparkSession, d: str) -> DataFrame:
    piece = _json(id=F.col("ordinal"), title=F.col("title"), createdTimestamp=F.unix_millis("first_seen_at"))
    return _parsed(spark, _documents(table(spark, d, "archive_item"), piece, "newsletter", '{"data":{"pageCount":1,"dataList":[', "]}}", ","))


@query("SELECT doc_no, CASE WHEN doc_no % 2 = 0 THEN NULL ELSE 'refused' END AS error, doc_no % 2 = 0 AS ok, CASE WHEN doc_no % 2 = 0 THEN n ELSE 0 END::INTEGER AS n_items FROM (SELECT min(ordinal) AS doc_no, count(*) AS n FROM archive_item WHERE trim(title) <> '' GROUP BY source)")
def source_statuses(spark: SparkSession, d: str) -> DataFrame:
    """One status a document; a fetch that failed is in it, with no items."""
    piece = _json(title=F.col("title"), url=F.col("url"), time=F.unix_seconds("first_seen_at"))
    docs = _documents(table(spark, d, "archive_item").where("trim(title) <> ''"), piece, "hot", '{"posts":[', "]}", ",").withColumn("error", F.when(F.col("doc_no") % 2 == 1, "refused"))
    return feeds.statuses(feeds.scan(docs, NOW)).select("doc_no", "error", "ok", F.col("n_items").cast("int").alias("n_items"))


_LIST = "(SELECT ordinal, title, category, xml_url FROM feed_subscription)"


@query(f"""
SELECT CASE ordinal % 4 WHEN 2 THEN category ELSE 'opmlrss:' || substr(sha1(CASE ordinal % 4 WHEN 1 THEN 'https://t.me/s/c' || ordinal ELSE xml_url END), 1, 10) END AS site_id, title AS feed_title, ordinal % 4 <> 3 AS ok,
 CASE ordinal % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END::INTEGER AS n_items, ordinal % 4 = 2 AS skipped, ordinal % 4 = 1 AS replaced, CASE ordinal % 4 WHEN 1 THEN 'telegram' END AS bridge_type,
 CASE ordinal % 4 WHEN 2 THEN 'no_official_rss_for_source_type' END AS skip_reason, row_number() OVER (ORDER BY title, ordinal) AS place FROM {_LIST}""")
def source_subscribed(spark: SparkSession, d: str) -> DataFrame:
    """The chain of a subscription list: every fourth feed is bridged, every fourth skipped, every fourth can't be read."""
    o = F.col("ordinal") % 4
    xml_url = F.when(o == 1, F.concat(F.lit("https://rsshub.app/telegram/channel/c"), "ordinal")).when(o == 2, F.concat(F.lit("https://rsshub.app/zhihu/"), "ordinal")).otherwise(F.col("xml_url"))
    subs = table(spark, d, "feed_subscription").select("ordinal", "title", "category", xml_url.alias("xml_url"), F.lit("").alias("html_url"))
    dead = {r[0] for r in subs.where("ordinal % 4 = 3").select("xml_url").collect()}  # a subscription list is small

    def fetch(url: str) -> str:
        if url in dead:
            raise OSError("refused")
        if url.startswith("https://t.me/s/"):
            return '<div class="tgme_widget_message" data-post="c/1"><div class="tgme_widget_message_text">Hello</div><time datetime="2025-11-05T10:00:00Z"></time></div>'
        return f"<rss><channel><item><title>One</title><link>{url}</link><pubDate>Wed, 05 Nov 2025 10:00:00 GMT</pubDate></item></channel></rss>"

    got = composed.subscribed(subs, fetch, NOW, tries=1)
    return ranked(got.statuses, "place").select("site_id", "feed_title", "ok", F.col("n_items").cast("int").alias("n_items"), "skipped", "replaced", "bridge_type", "skip_reason", "place")


# ---- sinks: payloads written and read ------------------------------------------------------------------


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{scratch(df.sparkSession, 'payload')}/{name}"
    payloads.swap_in(df, path)
    return payloads.payload(df.sparkSession, path)


@query(f"SELECT ordinal, id, title, strftime(published_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(published_at) % 1000000 <> 0 THEN '.' || lpad((epoch_us(published_at) % 1000000)::VARCHAR, 6, '0') ELSE '' END || 'Z' AS published_at, {_REDACTED.format(t='url')} AS url FROM {_VIEW}")
def payload_latest(spark: SparkSession, d: str) -> DataFrame:
    """The window as a payload: redacted, times as text, written and read."""
    rows = items.latest_first(_viewed(spark, d)).select("ordinal", "id", "title", "published_at", "url")
    return _written(payloads.as_text(rows), "latest").select("ordinal", "id", "title", "published_at", "url")


@query(f"SELECT ordinal, id, site_id, star, {_REDACTED.format(t='summary')} AS summary FROM archive_item")
def payload_archive(spark: SparkSession, d: str) -> DataFrame:
    a = archive.latest_first(table(spark, d, "archive_item")).select("ordinal", "id", "site_id", "star", "summary")
    return _written(a, "archive").select("ordinal", "id", "site_id", "star", "summary")


@query("SELECT title, max('译文' || ordinal) AS title_zh FROM (SELECT title, ordinal FROM archive_item WHERE ordinal % 3 = 0) GROUP BY title")
def payload_title_cache(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "archive_item").where("ordinal % 3 = 0").groupBy("title").agg(F.max(F.concat(F.lit("译文"), "ordinal")).alias("title_zh"))
    return _written(c, "cache").select("title", "title_zh")


@query(f"WITH {_PAGES} SELECT story_id, n AS item_count, {_REDACTED.format(t='title')} AS title, list_count AS n_links FROM p JOIN (SELECT page, count(*) AS list_count FROM v GROUP BY page) USING (page)")
def payload_stories(spark: SparkSession, d: str) -> DataFrame:
    s = _written(payloads.as_text(stories.in_order(_page_stories(spark, d))), "stories")
    return s.select("story_id", "item_count", "title", F.size("items").cast("long").alias("n_links"))


@query(f"SELECT strftime({_NOW}, '%Y-%m-%dT%H:%M:%SZ') AS generated_at, 24 AS window_hours, count(*) AS total_items, count(DISTINCT site_id || '::' || coalesce(source, '')) AS source_count, count(DISTINCT site_id) AS n_sites FROM {_VIEW}")
def payload_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _written(payloads.latest(_viewed(spark, d), NOW, 24), "summary")
    return s.select("generated_at", F.col("window_hours").cast("int").alias("window_hours"), "total_items", "source_count", F.size("site_stats").cast("long").alias("n_sites"))


@query("""
SELECT count(*) FILTER (ordinal % 4 <> 3) AS ok_feed_count, count(*) FILTER (ordinal % 4 = 3) AS failed_feed_count, count(*) FILTER (ordinal % 4 = 2) AS skipped_feed_count, count(*) AS feed_count,
 count(*) FILTER (ordinal % 4 <> 2) AS effective_feed_count, count(*) FILTER (ordinal % 4 <> 3) > 0 AS ok, CASE WHEN count(*) FILTER (ordinal % 4 = 3) > 0 THEN count(*) FILTER (ordinal % 4 = 3) || ' feeds failed' END AS error FROM feed_subscription""")
def payload_source_status(spark: SparkSession, d: str) -> DataFrame:
    o = F.col("ordinal") % 4
    s = table(spark, d, "feed_subscription").select((o != 3).alias("ok"), (o == 2).alias("skipped"), F.lit(False).alias("replaced"), F.lit(0).alias("n_items"), F.lit(0).alias("duration_ms"), F.when(o != 2, F.col("xml_url")).alias("effective_feed_url"))
    return _written(composed.summary(s), "status").select("ok_feed_count", "failed_feed_count", "skipped_feed_count", "feed_count", "effective_feed_count", "ok", "error")


@query(f"SELECT id, site_id, source, title, url, epoch_us(published_at) AS published FROM {_VIEW}")
def payload_slim(spark: SparkSession, d: str) -> DataFrame:
    return payloads.slim(_viewed(spark, d)).select("id", "site_id", "source", "title", "url", F.unix_micros("published_at").alias("published"))


@query(f"SELECT ordinal, json_extract_string(j, '$.id') AS id, json_extract_string(j, '$.title') AS title FROM (SELECT ordinal, json_object('id', id, 'title', title) AS j FROM {_VIEW})")
def payload_rows_as_json(spark: SparkSession, d: str) -> DataFrame:
    v = _viewed(spark, d).select("ordinal", "id", "title")
    return v.select("ordinal", payloads.as_json(v).alias("j")).select("ordinal", F.get_json_object("j", "$.id").alias("id"), F.get_json_object("j", "$.title").alias("title"))


@query("SELECT id, min(ordinal) AS ordinal, CASE WHEN min(ordinal) % 5 = 0 THEN ' ' ELSE arg_min(coalesce(summary, '-'), ordinal) END AS summary FROM archive_item GROUP BY id")
def archive_marked(spark: SparkSession, d: str) -> DataFrame:
    """Items that turned out to have no captions are marked by a summary of one space."""
    once = table(spark, d, "archive_item").withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("ordinal"))).where("_n = 1").withColumn("summary", F.coalesce("summary", F.lit("-"))).drop("_n")
    marked = archive.marked_without_captions(once, once.where("ordinal % 5 = 0").select("id"))
    return marked.select("id", "ordinal", "summary")
