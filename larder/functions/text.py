"""Text and number columns used by the page extractors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as white space (Unicode spaces, the four separators
# below U+0020 and NEL included).
WHITESPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stripped_text(c: Column | str) -> Column:
    """White space collapsed to single blanks, both ends trimmed; NULL stays NULL."""
    return F.trim(F.regexp_replace(col(c), WHITESPACE, " "))


def non_empty(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def rating_ratio(c: Column | str) -> Column:
    """``'3/4'`` -> 0.75; no match, an unreadable numerator or a zero denominator -> NULL."""
    parts = r"([\d.]+)\s*/\s*(\d+)"
    num = F.regexp_extract(col(c), parts, 1)
    den = F.regexp_extract(col(c), parts, 2)
    return F.try_divide(num.try_cast("double"), den.try_cast("double"))


def percent_ratio(c: Column | str) -> Column:
    """``'93%'`` -> 0.93, two places, half up; no match -> NULL."""
    num = F.regexp_extract(col(c), r"([\d.]+)\s*%", 1)
    return F.round(num.try_cast("double") * F.lit(0.01), 2)


def let(value: Column, body) -> Column:
    """Bind ``value`` to a name for ``body``, so that it is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)
