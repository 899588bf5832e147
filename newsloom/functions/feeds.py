"""Rules over subscriptions and domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip
from newsloom.functions.urls import authority, path

# Feeds that cannot be had, by prefix and by whole url, and feeds with an official replacement.
SKIP_PREFIXES = (
    "https://rsshub.app/telegram/channel/", "https://rsshub.app/jike/", "https://rsshub.app/bilibili/", "https://rsshub.app/zhihu/", "https://rsshub.app/xiaoyuzhou/podcast/",
    "https://rsshub.app/xyzrank", "https://rsshub.app/mittrchina/hot", "https://wechat2rss.bestblogs.dev/", "https://werss.bestblogs.dev/", "http://47.122.94.119:18080/",
)
SKIP_EXACT = ("https://flak.tedunangst.com/rss", "https://rachelbythebay.com/w/atom.xml")
REPLACEMENTS = {
    "https://rsshub.app/infoq/recommend": "https://www.infoq.cn/feed",
    "https://rsshub.app/huggingface/blog-zh": "https://huggingface.co/blog/feed.xml",
    "https://rsshub.app/readhub/daily": "https://readhub.cn/rss",
    "https://rsshub.app/36kr/hot-list": "https://36kr.com/feed",
    "https://rsshub.app/sspai/index": "https://sspai.com/feed",
    "https://rsshub.app/sspai/matrix": "https://sspai.com/feed",
    "https://rsshub.app/meituan/tech": "https://tech.meituan.com/feed",
    "https://mjg59.dreamwidth.org/data/rss": "http://mjg59.dreamwidth.org/data/rss",
}


def resolve(feed_url: Column) -> Column:
    """(url, reason): null url for a feed to skip, another url for one that was replaced."""
    u = strip(F.coalesce(feed_url, F.lit("")))
    to = F.try_element_at(F.create_map(*[F.lit(x) for kv in REPLACEMENTS.items() for x in kv]), u)
    none = F.lit(None).cast("string")
    barred = F.exists(F.array(*map(F.lit, SKIP_PREFIXES)), lambda p: u.startswith(p))

    def out(url: Column, reason: Column) -> Column:
        return F.struct(url.alias("url"), reason.alias("reason"))

    return (
        F.when(u == "", out(none, F.lit("empty_url")))
        .when(u.isin(*SKIP_EXACT), out(none, F.lit("no_official_rss_or_unreachable")))
        .when(barred, out(none, F.lit("no_official_rss_for_source_type")))
        .when(to.isNotNull(), out(to, F.lit("official_replacement")))
        .otherwise(out(u, none))
    )


def bridge(feed_url: Column, html_url: Column) -> Column:
    """(bridge_type, bridge_kind, bridge_slug, url) of channels that are read from their public page, or null."""
    u, page = strip(F.coalesce(feed_url, F.lit(""))), strip(F.coalesce(html_url, F.lit("")))
    parts = F.filter(F.split(path(u), "/"), lambda p: p != "")
    hub = (authority(u) == "rsshub.app") & (F.size(parts) >= 3)
    kinds = {"topic": "topics", "user": "users"}
    slug = F.try_element_at(F.filter(F.split(page, "/"), lambda p: p != ""), F.lit(-1))

    def out(kind: str, sub: str | None, name: Column, url: Column) -> Column:
        return F.struct(F.lit(kind).alias("bridge_type"), F.lit(sub).cast("string").alias("bridge_kind"), name.alias("bridge_slug"), url.alias("url"))

    third = F.try_element_at(parts, F.lit(3))
    rule = F.when(hub & (F.get(parts, F.lit(0)) == "telegram") & (F.get(parts, F.lit(1)) == "channel"), out("telegram", None, third, F.concat(F.lit("https://t.me/s/"), third)))
    for one, many in kinds.items():
        rule = rule.when(hub & (F.get(parts, F.lit(0)) == "jike") & (F.get(parts, F.lit(1)) == one), out("jike", one, third, F.concat(F.lit(f"https://m.okjike.com/{many}/"), third)))
    rule = rule.when(page.startswith("https://t.me/s/"), out("telegram", None, slug, page))
    for one, many in kinds.items():
        rule = rule.when(page.startswith(f"https://m.okjike.com/{many}/"), out("jike", one, slug, page))
    return rule


def mail_domain(sender: Column) -> Column:
    """The domain of a mail address, with or without a name around it."""
    return F.nullif(F.lower(F.regexp_extract(sender, r"@([A-Za-z0-9.-]+)", 1)), F.lit(""))


def domain_list(text: Column) -> Column:
    """Sorted set of the domains in a list by commas or spaces."""
    each = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[,\s]+"), lambda d: F.regexp_replace(d, r"^@", ""))
    return F.array_sort(F.array_distinct(F.filter(each, lambda d: d.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"))))


def domain_allowed(domain: Column, allowed: Column) -> Column:
    """Equal to, or below, one of ``allowed``; an empty list allows all."""
    return (F.size(allowed) == 0) | F.exists(allowed, lambda a: (domain == a) | domain.endswith(F.concat(F.lit("."), a)))
