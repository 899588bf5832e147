"""Text columns: trimming, squeezing, letters-only keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that show nothing at a text's ends: Unicode white space, zero-width marks, the byte order mark.
EDGE = r"[\s\u0085   -‍    ⁠　﻿]+"


# Letters that upper case writes as several.
FOLDED = {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl"}


def strip(c: Column) -> Column:
    """Without Unicode white space and invisible marks at the ends."""
    return F.regexp_replace(c, f"^{EDGE}|{EDGE}$", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and invisible text."""
    return F.coalesce(strip(c), F.lit("")) == ""


def squeeze(c: Column) -> Column:
    """Every stretch of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, EDGE, " "))


def fold(c: Column) -> Column:
    """Case set aside as by full case folding: also the sharp s, long s, final sigma and the ligatures.

    Lower case of upper case would say the same, but the optimizer takes it for plain lower case.
    """
    low = F.translate(F.lower(c), "ſς\u0131", "sσi")
    for one, many in FOLDED.items():
        low = F.replace(low, F.lit(one), F.lit(many))
    return low


def letters(c: Column) -> Column:
    """The letters and digits alone, case set aside."""
    return F.regexp_replace(fold(c), r"[^\p{L}\p{N}]+", "")


def first_non_empty(*cs: Column) -> Column:
    """The first value that is not blank, trimmed; else the empty string."""
    return F.coalesce(*[F.nullif(strip(c.cast("string")), F.lit("")) for c in cs], F.lit(""))
