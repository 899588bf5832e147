"""The whole run: state and new raw items to archive, view, stories, brief."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import is_blank
from newsloom.functions.titles import HAN
from newsloom.operators import archive as archives
from newsloom.operators import items, stories, view
from newsloom.runtime import cut


class Run(NamedTuple):
    archive: DataFrame
    shown: DataFrame
    items: DataFrame
    stories: DataFrame
    events: DataFrame
    brief: DataFrame
    cache: DataFrame


#: New translations of one run at most.
TRANSLATIONS = 80


def translated(shown: DataFrame, cache: DataFrame, translate: Callable[[str], str | None], most: int = TRANSLATIONS) -> DataFrame:
    """The title cache with new translations of English titles that have none: the latest first, until so many came out well.

    A translation counts only if it holds Han. Titles come to the driver one by one, and no further
    than the budget reaches.
    """
    open_ = view.bilingual(shown, cache).where("title_en is not null and title_zh is null")
    new: dict[str, str] = {}
    tried: set[str] = set()
    if most > 0:
        for r in items.latest_first(open_).select("title").toLocalIterator():
            if r.title in tried:
                continue
            tried.add(r.title)
            zh = translate(r.title)
            if zh and any(HAN[0] <= c <= HAN[-1] for c in zh):
                new[r.title] = zh
                if len(new) == most:
                    break
    return cache.select("title", "title_zh").unionByName(cache.sparkSession.createDataFrame(list(new.items()), "title string, title_zh string"))


def run(state: DataFrame, raw: DataFrame, now: dt.datetime, window_hours: int = view.WINDOW_HOURS, archive_days: int = archives.ARCHIVE_DAYS, cache: DataFrame | None = None, translate: Callable[[str], str | None] | None = None, most: int = TRANSLATIONS) -> Run:
    """One run at the clock ``now``; without new items it evaluates the archive anew.

    Archive, view and stories are written once in the shared folder, since several results read them.
    """
    merged = archives.upsert(state, archives.with_ids(archives.ingestible(raw)), now)
    kept = cut(archives.retained(merged, now, archive_days), "archive")
    shown = view.displayed(view.window(kept, now, window_hours))
    if cache is None:
        cache = state.sparkSession.createDataFrame([], "title string, title_zh string")
    if translate is not None:
        shown = cut(shown, "shown")
        cache = cut(translated(shown, cache, translate, most), "cache")
    shown = cut(view.bilingual(shown, cache), "shown")
    once = cut(items.suppressed(items.distinct_items(items.daily_items(shown))), "items")
    assigned = cut(stories.merged(once), "assigned")
    table = cut(stories.records(once, assigned, now, window_hours), "stories")
    return Run(kept, shown, once, table, stories.merge_events(assigned), stories.brief(table), cache.where(~is_blank(F.col("title"))))
