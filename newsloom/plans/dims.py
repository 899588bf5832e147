"""Dimensions of sites and tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Site, tier, label, rank. The odd label is the one that readers of the output know.
TIERS = (
    ("official_ai", "official", "AI 官方源", 0),
    ("aibreakfast", "ai_vertical", "AI 垂直源", 1),
    ("aihubtoday", "ai_vertical", "AI 垂直源", 1),
    ("aibase", "ai_vertical", "AI 垂直源", 1),
    ("bestblogs", "ai_vertical", "AI 垂直源", 1),
    ("followbuilders", "builders", "Builders", 2),
    ("opmlrss", "opmlrss", "RSS", 4),
    ("blog", "blog", "Blog", 3),
    ("business", "business", "Business", 3),
    ("convivium", "convivium", "Convivium", 3),
    ("culture", "culture", "Culture", 3),
    ("design", "design", "design", 3),
    ("finance", "finance", "Finance", 3),
    ("tech", "tech", "Tech", 3),
    ("techurls", "trending", "Tredning", 5),
    ("buzzing", "trending", "Trending", 5),
    ("iris", "trending", "Trending", 5),
    ("zeli", "trending", "Trending", 5),
    ("newsnow", "trending", "Trending", 5),
)
OTHER = ("other", "其他来源", 9)
# Weight of a tier; one that is missing weighs as much as other.
IMPORTANCE = {
    "official": 1.0, "ai_vertical": 0.78, "builders": 0.62, "blog": 0.5, "business": 0.5, "convivium": 0.5, "culture": 0.5,
    "design": 0.5, "finance": 0.5, "tech": 0.5, "advanced": 0.45, "trending": 0.32, "other": 0.25,
}
# Labels of story categories.
LABELS = {"official": "官方更新", "multi_source": "多源热议", "industry": "行业动态", "watch": "值得关注"}


def tier(site_id: Column) -> Column:
    """(source_tier, source_tier_label, source_tier_rank): by the id, by it in lower case, by its family, or other."""
    fields = ("source_tier", "source_tier_label", "source_tier_rank")

    def row(values: tuple) -> Column:
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, values, strict=True)])

    table = F.create_map(*[x for site, *rest in TIERS for x in (F.lit(site), row(tuple(rest)))])
    s = F.coalesce(site_id, F.lit(""))
    family = F.when(F.lower(s).startswith("opmlrss"), F.try_element_at(table, F.lit("opmlrss")))
    return F.coalesce(F.try_element_at(table, s), F.try_element_at(table, F.lower(s)), family, row(OTHER))


def importance_of(tier_name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in IMPORTANCE.items() for x in kv])
    return F.coalesce(F.try_element_at(table, tier_name), F.lit(IMPORTANCE["other"]))
