"""Dashboard datasets (E1-E6) over the silver series.

E1/E2 differ from the gold moves (D3) on purpose: they take the largest /
smallest change of any sign, so a key that only ever falls still has a
"biggest appreciation" row (its smallest fall). Each picks one row per key
with a single ``min(struct(...))`` aggregate (partial before the key shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import ascending_key, descending_key
from daybook.functions.previous import with_previous_value
from daybook.spec import SeriesSpec

# Column titles of the dashboard datasets.
CURRENCY = "Currency"
DATE = "Date"
PREVIOUS_RATE = "Previous Rate"
NEW_RATE = "New Rate"
CHANGE_UP = "Change (Appreciation)"
CHANGE_DOWN = "Change (Depreciation)"
DATE_HIGHEST = "Date of Highest Rate"
HIGHEST = "Highest Rate (PLN)"
DATE_LOWEST = "Date of Lowest Rate"
LOWEST = "Lowest Rate (PLN)"


def with_previous(series: DataFrame, spec: SeriesSpec, segment: int | None = None) -> DataFrame:
    """(k, d, v, prev, change) with ``prev`` the key's previous value by date."""
    k, d, v = spec.series_cols
    return with_previous_value(series.select(k, d, v), k, d, v, "_prev", segment).withColumn(
        "_chg", F.col(v) - F.col("_prev")
    )


def _first_per_key(
    df: DataFrame, k: str, prefix: list[Column], d: str, payload: dict[str, Column], method: str, order: Column
) -> DataFrame:
    """One row per key: the first by ``prefix`` then earliest ``d``."""
    if method == "window":
        w = Window.partitionBy(k).orderBy(order, F.col(d).asc())
        r = df.withColumn("_r", F.row_number().over(w)).where("_r = 1")
        return r.select(F.col(k), *[c.alias(n) for n, c in payload.items()])
    fields = [c.alias(f"_s{i}") for i, c in enumerate(prefix)] + [F.col(d).alias("_d")]
    fields += [c.alias(f"_p{i}") for i, c in enumerate(payload.values())]
    top = df.groupBy(k).agg(F.min(F.struct(*fields)).alias("_t"))
    return top.select(F.col(k), *[F.col(f"_t._p{i}").alias(n) for i, n in enumerate(payload)])


def _biggest_change(series: DataFrame, spec: SeriesSpec, up: bool, method: str) -> DataFrame:
    k, d, v = spec.series_cols
    ch = with_previous(series, spec).where(F.col("_chg").isNotNull())
    chg = F.col("_chg")
    payload = {
        DATE: F.col(d),
        PREVIOUS_RATE: F.col("_prev"),
        NEW_RATE: F.col(v),
        (CHANGE_UP if up else CHANGE_DOWN): chg,
    }
    prefix = descending_key(chg) if up else ascending_key(chg)
    order = chg.desc() if up else chg.asc()
    out = _first_per_key(ch, k, prefix, d, payload, method, order)
    return out.withColumnRenamed(k, CURRENCY).orderBy(CURRENCY)


def biggest_appreciation(series: DataFrame, spec: SeriesSpec, method: str = "aggregate") -> DataFrame:
    """Per key the day with the largest change (no sign filter)."""
    return _biggest_change(series, spec, up=True, method=method)


def biggest_depreciation(series: DataFrame, spec: SeriesSpec, method: str = "aggregate") -> DataFrame:
    """Per key the day with the smallest change (no sign filter)."""
    return _biggest_change(series, spec, up=False, method=method)


def _extreme_rate(series: DataFrame, spec: SeriesSpec, high: bool, method: str) -> DataFrame:
    k, d, v = spec.series_cols
    payload = {(DATE_HIGHEST if high else DATE_LOWEST): F.col(d), (HIGHEST if high else LOWEST): F.col(v)}
    prefix = descending_key(v) if high else ascending_key(v)
    order = F.col(v).desc() if high else F.col(v).asc()
    out = _first_per_key(series, k, prefix, d, payload, method, order)
    return out.withColumnRenamed(k, CURRENCY).orderBy(CURRENCY)


def highest_rates(series: DataFrame, spec: SeriesSpec, method: str = "aggregate") -> DataFrame:
    """Per key the highest value and its date."""
    return _extreme_rate(series, spec, high=True, method=method)


def lowest_rates(series: DataFrame, spec: SeriesSpec, method: str = "aggregate") -> DataFrame:
    """Per key the lowest value and its date."""
    return _extreme_rate(series, spec, high=False, method=method)


def rate_line_series(df: DataFrame, spec: SeriesSpec, scale: int | None = None) -> DataFrame:
    """E5: average value per key and date (the line chart's aggregation), in
    full or rounded to ``scale`` decimals. Partial aggregation before the shuffle."""
    k, d, v = spec.series_cols
    mean = F.avg(F.col(v))
    return df.groupBy(k, d).agg((mean if scale is None else F.round(mean, scale)).alias(f"avg({v})"))


def series_row_count(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The dataset's ``COUNT(*)`` measure over any subset of dimensions."""
    dims = list(dims)
    if not dims:
        return df.agg(F.count(F.lit(1)).alias("count"))
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("count"))
