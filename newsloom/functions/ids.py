"""Ids derived from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import first_non_empty, strip
from newsloom.functions.urls import canonical_story_url, normalize_url


def item_id(site_id: Column, source: Column, title: Column, url: Column) -> Column:
    """sha1 of site, source and title, trimmed and in lower case, and the normalized url."""
    low = [F.lower(strip(F.coalesce(c, F.lit("")))) for c in (site_id, source, title)]
    return F.sha1(F.concat_ws("||", *low, normalize_url(F.coalesce(url, F.lit("")))))


def story_id(url: Column, title: Column, item: Column) -> Column:
    basis = first_non_empty(canonical_story_url(F.coalesce(url, F.lit(""))), title, item)
    return F.concat(F.lit("story_"), F.substring(F.sha1(basis), 1, 12))


def feed_id(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 10)
