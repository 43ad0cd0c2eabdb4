"""Ordering keys, percentages and date parsing as Spark column expressions.

The extreme-value operators pick "the row that sorts first" with one
``min(struct(...))`` aggregate instead of a ranking window. A struct compares
field by field, so leading the struct with the key columns below reproduces
Spark's ``ORDER BY x ASC`` / ``ORDER BY x DESC`` exactly, including NULL and
NaN placement; the next struct field (the date) breaks ties, earliest first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.spec import DATE_PATTERN


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ascending_key(x: str | Column) -> list[Column]:
    """Struct prefix ordered like ``ORDER BY x ASC`` (NULLs first, NaN last)."""
    return [_c(x)]


def descending_key(x: str | Column) -> list[Column]:
    """Struct prefix ordered like ``ORDER BY x DESC`` (NaN first, NULLs last).

    ``-x`` alone would be wrong twice: NULLs would come first and NaN (the
    greatest double in Spark) would come last.
    """
    x = _c(x).cast("double")
    return [x.isNull(), ~F.isnan(x), -x]


def percentage(part: str | Column, total: str | Column) -> Column:
    """``part / total * 100`` as a double, 0 when ``total`` is 0."""
    part, total = _c(part), _c(total)
    return F.when(total > 0, part.cast("double") / total.cast("double") * F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def safe_ratio_pct(num: str | Column, den: str | Column) -> Column:
    """``num / den * 100``; NULL instead of a division-by-zero error."""
    return F.try_divide(_c(num), _c(den)) * F.lit(100.0)


def rounded_percentage(num: str | Column, den: str | Column, scale: int) -> Column:
    return F.round(safe_ratio_pct(num, den), scale)


def parsed_date(d: str | Column) -> Column:
    """Strict ``yyyy-MM-dd`` parse; NULL for anything else (never raises)."""
    return F.try_to_date(_c(d), DATE_PATTERN)
