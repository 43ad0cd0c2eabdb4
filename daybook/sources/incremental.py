"""Incremental loading: watermark, batch selection and load-window coverage.

The watermark is one global ``max(date)`` of the target (not per key - a key
missing on the last date is not back-filled; ``load_window_coverage`` and the
missing-key check make such holes visible). It is resolved to a literal before
the source is filtered, so the range predicate on the string date reaches the
Parquet scan (``PushedFilters``) and skips row groups by their min/max stats.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import parsed_date


def _as_date(x: str | dt.date) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(x)


def add_years(day: dt.date, years: int) -> dt.date:
    """Calendar-year step; 29 February falls back to the 28th."""
    y = day.year + years
    return day.replace(year=y, day=min(day.day, calendar.monthrange(y, day.month)[1]))


# ---------------------------------------------------------------- A3


def high_watermark(target: DataFrame, d: str) -> DataFrame:
    """A3: one row, the latest date in the target (NULL when empty)."""
    return target.agg(F.max(F.col(d)).alias("watermark"))


def watermark_value(target: DataFrame | None, d: str) -> str | None:
    """The watermark as a Python value: one aggregated scalar, read once.
    Only valid dates count: a stored ``2024-13-40`` must not hide later loads."""
    if target is None:
        return None
    return high_watermark(target.where(parsed_date(d).isNotNull()), d).first()["watermark"]


# ---------------------------------------------------------------- A4


def batch_bounds(as_of: str | dt.date, watermark: str | None, years_back: int) -> tuple[str, str, bool]:
    """(low, high, low_inclusive) of the next batch.

    Full mode (no watermark): ``[as_of - years_back years, as_of]``.
    Incremental: ``(watermark, as_of]``; empty when the watermark has
    reached ``as_of``.
    """
    end = _as_date(as_of)
    if watermark is None:
        return add_years(end, -years_back).isoformat(), end.isoformat(), True
    return str(watermark), end.isoformat(), False


def incremental_batch(
    source: DataFrame,
    d: str,
    as_of: str | dt.date,
    target: DataFrame | None = None,
    watermark: str | None = None,
    years_back: int = 5,
) -> DataFrame:
    """A4: the source rows a load run at ``as_of`` picks up.

    Pass ``target`` (its watermark is read) or a known ``watermark``.
    """
    if watermark is None and target is not None:
        watermark = watermark_value(target, d)
    low, high, inclusive = batch_bounds(as_of, watermark, years_back)
    col = F.col(d)
    lower = col >= F.lit(low) if inclusive else col > F.lit(low)
    return source.where(lower & (col <= F.lit(high)))


# ---------------------------------------------------------------- A5


def load_windows(start: str | dt.date, end: str | dt.date) -> list[tuple[str, str]]:
    """Load windows of at most one calendar year, both ends inclusive; the
    next window starts the day after the previous one ends. The last day is
    always covered (``<=`` on dates). A handful of bounds per decade."""
    s, e = _as_date(start), _as_date(end)
    out = []
    while s <= e:
        we = min(add_years(s, 1), e)
        out.append((s.isoformat(), we.isoformat()))
        s = we + dt.timedelta(days=1)
    return out


def load_window_coverage(
    df: DataFrame,
    k: str,
    d: str,
    keys: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
) -> DataFrame:
    """A5: rows per expected key and load window, zeros included.

    One grouped pass counts each window as its own ``count_if`` column (the
    window list is a few literals), then each key's counts are unpivoted.
    Keys come from ``keys`` (left join), so a key with no rows at all still
    reports a zero for every window. No cross product is built.
    """
    wins = load_windows(start, end)
    if not wins:  # up to date: no window to cover
        none = keys.select(F.col(k).cast("string").alias(k)).where(F.lit(False))
        return none.select(k, *[F.lit(None).cast(t).alias(c) for c, t in (("window_start", "string"), ("window_end", "string"), ("n", "long"))])
    col = F.col(d)
    in_range = (col >= F.lit(wins[0][0])) & (col <= F.lit(wins[-1][1]))
    counts = (
        df.where(in_range)
        .groupBy(F.col(k).cast("string").alias(k))
        .agg(*[F.count_if((col >= F.lit(a)) & (col <= F.lit(b))).alias(f"_n{i}") for i, (a, b) in enumerate(wins)])
    )
    exp = keys.select(F.col(k).cast("string").alias(k)).distinct()
    joined = exp.join(counts, on=k, how="left")
    cells = [
        F.struct(
            F.lit(a).alias("window_start"),
            F.lit(b).alias("window_end"),
            F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("long").alias("n"),
        )
        for i, (a, b) in enumerate(wins)
    ]
    return joined.select(k, F.inline(F.array(*cells)))


def keys_frame(spark, k: str, keys: Sequence[str]) -> DataFrame:
    from daybook.operators.quality import expected_keys_frame

    return expected_keys_frame(spark, k, keys)
