"""Gold analytics: extremes, day-over-day changes, biggest moves, summary.

Plan shapes (see ``explain``):

* ``historical_extremes`` / ``extreme_daily_movements``: one ``groupBy(key)``
  with two ``min(struct(...))`` aggregates - partial aggregation before the
  key shuffle, no ranking window, no self-join. Result size = number of keys.
* ``daily_changes``: the plain ``lag`` per key. Silver is unique on
  (key, date), so a key holds at most one row per calendar day however
  skewed the raw copies were (``segment`` splits longer series, see
  ``functions.previous``).
* ``executive_summary_from_series`` fuses all of it: the lag has already
  partitioned by key, so extremes and moves are one aggregate over the changes
  without a further shuffle or a join.

Ties: the earliest date wins (the struct's next field is the date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import ascending_key, descending_key, rounded_percentage
from daybook.functions.previous import with_previous_value
from daybook.spec import SeriesSpec

CALCULATED_AT = "calculated_at"

# Direction labels and record-count labels of the gold layer.
APPRECIATION = "Appreciation"
DEPRECIATION = "Depreciation"
NO_CHANGE = "No Change"
COUNT_LABELS = ("Historical Extremes", "Daily Changes", "Extreme Daily Movements")

CHANGE_COLS = (
    "current_rate",
    "previous_rate",
    "daily_change_absolute",
    "daily_change_percentage",
    "movement_direction",
)


def _keyed(prefix: list[Column], payload: dict[str, Column]) -> Column:
    """struct(sort prefix..., payload...) with unique field names."""
    fields = [c.alias(f"_s{i}") for i, c in enumerate(prefix)]
    fields += [c.alias(name) for name, c in payload.items()]
    return F.struct(*fields)


def _stamp(df: DataFrame, stamp: bool, name: str = CALCULATED_AT) -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if stamp else df


# ---------------------------------------------------------------- D1


def _extreme_aggs(d: str, v: str) -> tuple[Column, Column]:
    payload = {"d": F.col(d), "v": F.col(v)}
    lo = F.min(_keyed(ascending_key(v) + [F.col(d)], payload)).alias("_lo")
    hi = F.min(_keyed(descending_key(v) + [F.col(d)], payload)).alias("_hi")
    return lo, hi


def _extreme_col_map() -> dict[str, Column]:
    lo, hi = F.col("_lo.v"), F.col("_hi.v")
    return {
        "lowest_rate": lo,
        "date_lowest_rate": F.col("_lo.d"),
        "highest_rate": hi,
        "date_highest_rate": F.col("_hi.d"),
        "historical_range": hi - lo,
        "range_percentage": rounded_percentage(hi - lo, lo, 2),
    }


def _extreme_cols(k: str) -> list[Column]:
    return [F.col(k)] + [c.alias(n) for n, c in _extreme_col_map().items()]


def historical_extremes(series: DataFrame, spec: SeriesSpec, stamp: bool = True) -> DataFrame:
    """Per key the lowest and the highest value with their dates, the
    range and ``ROUND(range / lowest * 100, 2)`` (NULL when lowest is 0)."""
    k, d, v = spec.series_cols
    lo, hi = _extreme_aggs(d, v)
    out = series.groupBy(k).agg(lo, hi).select(*_extreme_cols(k))
    return _stamp(out, stamp)


# ---------------------------------------------------------------- D2


def direction(current: Column, previous: Column) -> Column:
    return (
        F.when(current > previous, F.lit(APPRECIATION))
        .when(current < previous, F.lit(DEPRECIATION))
        .otherwise(F.lit(NO_CHANGE))
    )


def daily_changes(
    series: DataFrame, spec: SeriesSpec, stamp: bool = True, segment: int | None = None
) -> DataFrame:
    """Per row the previous available value of the key (by date), the
    absolute change, ``ROUND(change / previous * 100, 4)`` and the direction.
    A key's first row has no previous value and direction ``No Change``.

    ``segment`` splits each key's series by a prefix of the date, for series
    that are not unique per (key, date) (see ``functions.previous``)."""
    k, d, v = spec.series_cols
    base = with_previous_value(series.select(k, d, v), k, d, v, "previous_rate", segment).select(
        k, d, F.col(v).alias("current_rate"), "previous_rate"
    )
    cur, pre = F.col("current_rate"), F.col("previous_rate")
    out = base.select(
        k,
        d,
        cur,
        pre,
        (cur - pre).alias("daily_change_absolute"),
        rounded_percentage(cur - pre, pre, 4).alias("daily_change_percentage"),
        direction(cur, pre).alias("movement_direction"),
    )
    return _stamp(out, stamp)


# ---------------------------------------------------------------- D3


def _move_aggs(d: str) -> tuple[Column, Column]:
    chg = F.col("daily_change_absolute")
    payload = {
        "d": F.col(d),
        "cur": F.col("current_rate"),
        "prev": F.col("previous_rate"),
        "chg": chg,
        "pct": F.col("daily_change_percentage"),
    }
    is_ = lambda label: F.col("movement_direction") == label
    # min(...) skips NULLs, so a CASE inside the aggregate acts as FILTER
    dep = F.min(F.when(is_(DEPRECIATION), _keyed(ascending_key(chg) + [F.col(d)], payload))).alias("_dep")
    app = F.min(F.when(is_(APPRECIATION), _keyed(descending_key(chg) + [F.col(d)], payload))).alias("_app")
    return dep, app


MOVE_NAMES = (
    "date_biggest_depreciation",
    "rate_on_depreciation_date",
    "previous_rate_depreciation",
    "biggest_daily_fall_absolute",
    "biggest_daily_fall_percentage",
    "date_biggest_appreciation",
    "rate_on_appreciation_date",
    "previous_rate_appreciation",
    "biggest_daily_rise_absolute",
    "biggest_daily_rise_percentage",
)
_MOVE_FIELDS = ("d", "cur", "prev", "chg", "pct")


def _move_col_map() -> dict[str, Column]:
    srcs = [f"_dep.{f}" for f in _MOVE_FIELDS] + [f"_app.{f}" for f in _MOVE_FIELDS]
    return {name: F.col(src) for name, src in zip(MOVE_NAMES, srcs)}


def _move_cols() -> list[Column]:
    return [c.alias(n) for n, c in _move_col_map().items()]


def extreme_daily_movements(changes: DataFrame, spec: SeriesSpec, stamp: bool = True) -> DataFrame:
    """D3: per key the biggest fall (Depreciation row with the smallest
    change) and the biggest rise (Appreciation row with the largest change)
    on one row. A key lacking either kind of move is absent."""
    k, d = spec.k, spec.d
    base = changes.where(F.col("previous_rate").isNotNull())
    dep, app = _move_aggs(d)
    out = (
        base.groupBy(k)
        .agg(dep, app)
        .where(F.col("_dep").isNotNull() & F.col("_app").isNotNull())
        .select(F.col(k), *_move_cols())
    )
    return _stamp(out, stamp)


# ---------------------------------------------------------------- D4 / D5

SUMMARY_RENAMES = (
    ("lowest_rate", "all_time_low_rate"),
    ("date_lowest_rate", "all_time_low_date"),
    ("highest_rate", "all_time_high_rate"),
    ("date_highest_rate", "all_time_high_date"),
    ("historical_range", "volatility_range"),
    ("range_percentage", "volatility_percentage"),
    ("biggest_daily_fall_absolute", "biggest_daily_fall_absolute"),
    ("biggest_daily_fall_percentage", "biggest_daily_fall_percentage"),
    ("date_biggest_depreciation", "worst_single_day_date"),
    ("biggest_daily_rise_absolute", "biggest_daily_rise_absolute"),
    ("biggest_daily_rise_percentage", "biggest_daily_rise_percentage"),
    ("date_biggest_appreciation", "best_single_day_date"),
)


def executive_summary(extremes: DataFrame, movements: DataFrame, spec: SeriesSpec) -> DataFrame:
    """D4 over stored gold tables: extremes inner join movements on the key.
    ``last_updated`` is the extremes' ``calculated_at`` when present."""
    k = spec.k
    e = extremes.alias("h")
    m = movements.alias("e")
    j = e.join(m, on=F.col(f"h.{k}") == F.col(f"e.{k}"), how="inner")
    cols = [F.col(f"h.{k}").alias(k)]
    for src, dst in SUMMARY_RENAMES:
        side = "h" if src in extremes.columns else "e"
        cols.append(F.col(f"{side}.{src}").alias(dst))
    if CALCULATED_AT in extremes.columns:
        cols.append(F.col(f"h.{CALCULATED_AT}").alias("last_updated"))
    return j.select(*cols)


def executive_summary_from_series(series: DataFrame, spec: SeriesSpec, stamp: bool = True) -> DataFrame:
    """D4 in one pass over silver: extremes and moves are aggregated together
    on the output of the ``lag`` (one key aggregate in the partitioning the
    lag already has; no join of result tables). A key's first row has direction
    ``No Change`` and so never enters the move aggregates."""
    k, d = spec.k, spec.d
    ch = daily_changes(series, spec, stamp=False)
    lo, hi = _extreme_aggs(d, "current_rate")
    dep, app = _move_aggs(d)
    agg = ch.groupBy(k).agg(lo, hi, dep, app).where(F.col("_dep").isNotNull() & F.col("_app").isNotNull())
    src = {**_extreme_col_map(), **_move_col_map()}
    out = agg.select(F.col(k), *[src[a].alias(b) for a, b in SUMMARY_RENAMES])
    return _stamp(out, stamp, "last_updated")


def gold_record_counts(extremes: DataFrame, changes: DataFrame, movements: DataFrame) -> DataFrame:
    """Label and row count of the three gold tables."""
    parts = [
        t.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(label).alias("table_name"), "record_count"
        )
        for label, t in zip(COUNT_LABELS, (extremes, changes, movements))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
