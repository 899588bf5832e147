"""Url columns, built from array expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip


#: Separates the parts of a canonical key; it occurs in no url.
SEP = "\u0001"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"


def unescape(c: Column) -> Column:
    """Percent-escapes decoded; a text whose escapes are broken stays as it is, escapes in capitals."""
    plain = F.try_url_decode(F.regexp_replace(c, r"\+", "%2B"))
    kept = F.when(plain.contains("�"), F.lit(None)).otherwise(plain)
    return F.when(~c.contains("%"), c).otherwise(F.coalesce(kept, c))


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _SCHEME, 1))


def authority(u: Column) -> Column:
    """Host with port and user, in lower case; the empty string without ``scheme://``."""
    return F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path(u: Column) -> Column:
    return F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)


def params(u: Column) -> Column:
    """The pieces of the query between ``&``, without empty ones."""
    return F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), lambda p: p != "")


def fragment(u: Column) -> Column:
    return F.regexp_extract(u, r"#(.*)$", 1)


def spelling_key(u: Column) -> Column:
    """Equal for urls that differ only in case of scheme and host, percent-escapes, a final ``/`` of
    the path and the order of parameters. ``u`` is stripped; being used often, it should be a plain column."""
    return F.concat_ws(
        SEP,
        scheme(u),
        authority(u),
        unescape(F.regexp_replace(path(u), "/$", "")),
        F.array_join(F.array_sort(F.transform(params(u), unescape)), "&"),
        unescape(fragment(u)),
    )


# Query keys that name a campaign and not a page.
CAMPAIGN_KEYS = ("ref", "spm", "fbclid", "gclid", "igshid", "mkt_tok", "mc_cid", "mc_eid", "_hsenc", "_hsmi")
CAMPAIGN_PREFIX = "utm_"
# Fixed value: query keys that tell stories of one page apart.
IDENTITY_KEYS = ("id", "item", "p")


def _encode(c: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped."""
    return F.regexp_replace(F.regexp_replace(F.url_encode(c), "%7E", "~"), r"\*", "%2A")


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _with(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _rebuilt(raw: Column, keep) -> Column:
    """The url with only the parameters that ``keep`` accepts by their lower-case key, spelled in one way."""

    def pair(p: Column) -> Column:
        return F.struct(_decode(F.substring_index(p, "=", 1)).alias("k"), F.when(p.contains("="), _decode(F.regexp_replace(p, "^[^=]*=", ""))).alias("v"))

    def query(u: Column) -> Column:
        kept = F.filter(F.transform(params(u), pair), lambda x: keep(F.lower(x["k"])))
        return F.array_join(F.transform(kept, lambda x: F.concat(_encode(x["k"]), F.lit("="), F.coalesce(_encode(x["v"]), F.lit("")))), "&")

    def whole(u: Column) -> Column:
        head = F.concat(scheme(u), F.lit("://"), authority(u), path(u))
        # Most urls have no query; those are done with their head.
        asked = F.when(u.contains("?"), _with(query(u), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))).otherwise("")
        return F.when(scheme(u) == "", u).otherwise(F.regexp_replace(F.concat(head, asked), "/+$", ""))

    return _with(strip(raw), whole)


def normalize_url(raw: Column) -> Column:
    """Lower-case scheme and host, no campaign parameters, no fragment, no final slashes; without scheme the trimmed text."""
    return _rebuilt(raw, lambda k: ~(k.startswith(CAMPAIGN_PREFIX) | k.isin(*CAMPAIGN_KEYS)))


def canonical_story_url(raw: Column, identity: tuple[str, ...] = IDENTITY_KEYS) -> Column:
    """The normalized url with only the parameters in ``identity``; with the default, videos that differ by ``v`` fall together."""
    return _rebuilt(raw, lambda k: k.isin(*identity))


def host_of(u: Column) -> Column:
    """Host in lower case, with port and user."""
    return authority(strip(u))


def video_id(u: Column) -> Column:
    """The id in ``v=``, ``/shorts/``, ``/live/`` or ``youtu.be/``; the first that is there, or null."""
    forms = (r"[?&]v=([\w-]{6,})", r"/shorts/([\w-]{6,})", r"/live/([\w-]{6,})", r"youtu\.be/([\w-]{6,})")
    return F.coalesce(*[F.nullif(F.regexp_extract(u, f, 1), F.lit("")) for f in forms])


def thumbnail(u: Column) -> Column:
    is_video = u.contains("youtube.com") | u.contains("youtu.be")
    return F.when(is_video, F.concat(F.lit("https://img.youtube.com/vi/"), video_id(u), F.lit("/mqdefault.jpg")))
