"""Title columns: tokens, entities, story titles, snippets, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import EDGE, squeeze, strip

# Words that tell nothing in a title.
STOPWORDS = ("a", "an", "and", "are", "as", "at", "for", "from", "in", "into", "is", "new", "of", "on", "the", "to", "with", "发布", "推出", "上线", "更新")
# Names by which a vendor is recognised.
VENDORS = {
    "openai": "openai", "anthropic": "anthropic", "claude": "anthropic", "google": "google", "deepmind": "google", "gemini": "google",
    "microsoft": "microsoft", "github": "github", "huggingface": "huggingface", "hugging face": "huggingface", "meta": "meta",
    "llama": "meta", "deepseek": "deepseek", "mistral": "mistral", "xai": "xai", "grok": "xai",
}
# Patterns of model names, mail addresses, secrets, garbled signs, AI words.
MODEL = r"(?i)\b(gpt[-\s]?\d+(?:\.\d+)?[a-z]*|claude(?:[-\s]?(?:opus|sonnet|haiku))?[-\s]?\d+(?:\.\d+)?|gemini[-\s]?\d+(?:\.\d+)?|llama[-\s]?\d+(?:\.\d+)?|deepseek[-\s]?[a-z0-9.]+|grok[-\s]?\d+(?:\.\d+)?|mistral[-\s]?[a-z0-9.]+)\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
SECRET = r"(?i)\b(sk-(?!hynix\b)[A-Za-z0-9_-]{12,}|(?:api[_-]?key|secret|token)=([^\s&]{6,}))\b"
AI_SIGNAL = r"(?i)(?<![a-z0-9])(ai|aigc|llm|gpt|openai|anthropic|deepseek|gemini|claude|robot|robotics|embodied|autonomous|machine learning|artificial intelligence|transformer|diffusion)(?![a-z0-9])"
AI_KEYWORDS = (
    "aigc", "llm", "gpt", "claude", "gemini", "deepseek", "openai", "anthropic", "copilot", "codex", "mcp", "hugging face", "huggingface",
    "transformer", "prompt", "diffusion", "agent", "多模态", "大模型", "模型", "人工智能", "机器学习", "深度学习", "智能体", "算力", "推理", "微调",
)
BROAD_AI_KEYWORDS = ("agent", "模型", "推理")
NOISE = r"Ã.|Â.|â€.|[\x{80}-\x{9f}]|�"
HAN = "一-鿿"


def has_noise(s: Column) -> Column:
    """Signs that a text was read in the wrong encoding."""
    return F.coalesce(s.rlike(NOISE), F.lit(False))




def has_han(s: Column) -> Column:
    return F.coalesce(s.rlike(f"[{HAN}]"), F.lit(False))


def mostly_english(s: Column) -> Column:
    """Not blank, without Han, and Latin letters make up a quarter, six at least."""
    t = strip(F.coalesce(s, F.lit("")))
    n = F.length(F.regexp_replace(t, "[^A-Za-z]", ""))
    return (t != "") & ~has_han(t) & (n >= F.greatest(F.lit(6), F.floor(F.length(t) / 4)))


def clip(text: Column, limit: int = 96) -> Column:
    """White space squeezed; longer than ``limit``, cut there with an ellipsis as its last character."""
    s = squeeze(F.coalesce(text, F.lit("")))
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.regexp_replace(F.substring(s, 1, limit - 1), f"{EDGE}$", ""), F.lit("…")))


def redact(s: Column) -> Column:
    """Mail addresses, then what looks like a secret, replaced by marks."""
    return F.regexp_replace(F.regexp_replace(s, EMAIL, "[redacted-email]"), SECRET, "[redacted-secret]")


def snippet(text: Column, limit: int = 240) -> Column:
    """Squeezed and redacted before it is cut, so that no half of an address is left."""
    return clip(redact(squeeze(text)), limit)


def _redacted(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return redact(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _redacted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: _redacted(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_redacted(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c


def redact_all(df: DataFrame) -> DataFrame:
    """Every string value of every column, however deep, redacted; keys of maps stay."""
    return df.select(*[_redacted(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def story_title(title: Column, bilingual: Column | None = None) -> Column:
    """Lower case; the part behind `` / `` is cut where a bilingual title is given; white space squeezed."""
    t = F.lower(F.coalesce(title, F.lit("")))
    if bilingual is not None:
        t = F.when(F.coalesce(bilingual, F.lit("")) != "", F.regexp_replace(F.lower(bilingual), r"\s*/\s*.+$", "")).otherwise(t)
    return squeeze(t)


def tokens(title: Column) -> Column:
    """Set of words: runs of Latin letters and digits, and of two or more Han; no urls, stopwords, single letters."""
    t = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"https?://\S+", " ")
    found = F.regexp_extract_all(t, F.lit(f"([a-z0-9]+|[{HAN}]{{2,}})"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) >= 2) & ~w.isin(*STOPWORDS)))


def mergeable(title: Column, words: Column) -> Column:
    """Long enough to be compared: four words and eighteen characters."""
    return (F.size(words) >= 4) & (F.length(title) >= 18)


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def vendors(title: Column) -> Column:
    t = F.lower(F.coalesce(title, F.lit("")))
    each = F.array(*[F.when(t.contains(alias), F.lit(name)) for alias, name in VENDORS.items()])
    return F.array_sort(F.array_distinct(F.filter(each, lambda v: v.isNotNull())))


def models(title: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(MODEL), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda m: F.regexp_replace(m, r"\s+", "-"))))


def compatible(a: Column, b: Column) -> Column:
    """False where both sets name something and share nothing."""
    return ~((F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b))


def contains_any(text: Column, words) -> Column:
    t = F.lower(text)
    return F.exists(F.array(*map(F.lit, words)), lambda w: t.contains(w))


def ai_signal(text: Column) -> Column:
    return text.rlike(AI_SIGNAL) | contains_any(text, [w for w in AI_KEYWORDS if w not in BROAD_AI_KEYWORDS])
