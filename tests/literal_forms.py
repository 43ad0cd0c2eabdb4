"""The gold picks as literal rankings, for tests and the benchmark to compare with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import rounded_percentage
from daybook.operators.gold import APPRECIATION, DEPRECIATION, MOVE_NAMES
from daybook.spec import SeriesSpec


def extremes_by_rank(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Two ``row_number`` rankings joined on the key (the literal form)."""
    k, d, v = spec.series_cols
    rank = lambda o: F.row_number().over(Window.partitionBy(k).orderBy(o, F.col(d).asc()))
    r = series.select(k, d, v, rank(F.col(v).asc()).alias("_rl"), rank(F.col(v).desc()).alias("_rh"))
    lo = r.where("_rl = 1").select(k, F.col(v).alias("lowest_rate"), F.col(d).alias("date_lowest_rate"))
    hi = r.where("_rh = 1").select(k, F.col(v).alias("highest_rate"), F.col(d).alias("date_highest_rate"))
    j = lo.join(hi, k)
    return j.select(
        k,
        "lowest_rate",
        "date_lowest_rate",
        "highest_rate",
        "date_highest_rate",
        (F.col("highest_rate") - F.col("lowest_rate")).alias("historical_range"),
        rounded_percentage(F.col("highest_rate") - F.col("lowest_rate"), F.col("lowest_rate"), 2).alias(
            "range_percentage"
        ),
    )


def moves_by_rank(changes: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Two rankings of the changes joined on the key."""
    base = changes.where(F.col("previous_rate").isNotNull())
    k, d = spec.k, spec.d
    chg = F.col("daily_change_absolute")

    def side(label: str, order: Column, names: list[str]) -> DataFrame:
        w = Window.partitionBy(k).orderBy(order, F.col(d).asc())
        s = base.where(F.col("movement_direction") == label).withColumn("_r", F.row_number().over(w))
        src = [d, "current_rate", "previous_rate", "daily_change_absolute", "daily_change_percentage"]
        return s.where("_r = 1").select(k, *[F.col(a).alias(b) for a, b in zip(src, names)])

    dep = side(DEPRECIATION, chg.asc(), list(MOVE_NAMES[:5]))
    app = side(APPRECIATION, chg.desc(), list(MOVE_NAMES[5:]))
    return dep.join(app, k)
