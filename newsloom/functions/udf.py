"""What built-in expressions cannot say, in Arrow batches."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

@F.pandas_udf(DoubleType())
def similarity_from(a: pd.Series, b: pd.Series, jaccard: pd.Series, floor: pd.Series) -> pd.Series:
    """Likeness of two titles where it reaches the floor; below it, that or zero."""
    return pd.Series([0.0 if j is None or j != j else ratio(x, y, j, f) for x, y, j, f in zip(a, b, jaccard, floor, strict=True)], dtype=float)


_SIGNS = re.compile("[ÃÂâ€]|[\x80-\x9f]|å|æ|ç")


def ratio(a: str, b: str, jaccard: float, floor: float = 0.0) -> float:
    """The greater of the matching ratio and its mean with the word overlap (three to two).

    With a floor, zero for pairs that cheap upper bounds of the ratio show to stay below it.
    """
    m = SequenceMatcher(None, a, b)
    least = min(floor, (floor - 0.4 * jaccard) / 0.6) - 1e-4
    if floor and (m.real_quick_ratio() < least or m.quick_ratio() < least):
        return 0.0
    s = m.ratio()
    return round(max(s, 0.6 * s + 0.4 * jaccard), 4)


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series, jaccard: pd.Series) -> pd.Series:
    """Likeness of two titles, the later one first; nothing if either has no words (jaccard null)."""
    return pd.Series([0.0 if j is None or j != j else ratio(x, y, j) for x, y, j in zip(a, b, jaccard, strict=True)], dtype=float)


def _undone(s: str | None) -> str | None:
    if s and _SIGNS.search(s):
        for code in ("latin-1", "cp1252"):
            try:
                t = s.encode(code).decode("utf-8")
            except UnicodeError:
                continue
            if t and t != s:
                return t
    return s


@F.pandas_udf(StringType())
def undo_mojibake(s: pd.Series) -> pd.Series:
    """Text that was UTF-8 read once as a western code page, decoded again; all else as it is."""
    return s.map(_undone, na_action="ignore")
