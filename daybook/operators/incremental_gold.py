"""Gold from summaries of segments: extremes and biggest moves without reading old rows.

A key's series is cut into segments by a prefix of the date. A segment's summary
holds its first and last (date, value), its lowest and highest value and its
biggest fall and rise, changes counted inside the segment only. Summaries of
neighbouring segments merge: extremes by their order, moves by theirs and by
the one change from the last value of a segment to the first of the next. So

* a batch, in order or late, recomputes only the summaries of the segments it
  touches, from those segments' rows (``merge_rows`` rewrote the same partitions
  of silver);
* D1 and D3 are folded from the summaries, one row for each key and segment. The
  change across a segment's border is repaired by itself, being made anew in
  every fold.

The results equal ``gold.historical_extremes`` and ``gold.extreme_daily_movements``
of the whole series (values, ties, NULL and NaN order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import rounded_percentage
from daybook.operators import gold
from daybook.sinks import partitions
from daybook.spec import SeriesSpec

#: Characters of the date that tell segments apart ("yyyy-MM").
MONTH = 7
SEGMENT = "segment"


def segment_of(d: str, length: int = MONTH) -> Column:
    """The segment of a date: 's' and its prefix; 'n' for NULL, which sorts first as NULL does (a partition's name is never empty)."""
    return F.coalesce(F.concat(F.lit("s"), F.substring(F.col(d), 1, length)), F.lit("n"))


def _changes(cur: Column, pre: Column) -> dict[str, Column]:
    return {
        "current_rate": cur,
        "previous_rate": pre,
        "daily_change_absolute": cur - pre,
        "daily_change_percentage": rounded_percentage(cur - pre, pre, 4),
        "movement_direction": gold.direction(cur, pre),
    }


def summaries(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row for each key and segment of a series (key, date, value, segment), unique per (key, date)."""
    k, d, v = spec.series_cols
    inside = Window.partitionBy(k, SEGMENT).orderBy(F.col(d))
    rows = series.select(k, SEGMENT, d, v, F.lag(v).over(inside).alias("_prev"))
    rows = rows.select(k, SEGMENT, d, *[c.alias(n) for n, c in _changes(F.col(v), F.col("_prev")).items()])
    at = F.struct(F.col(d).alias("d"), F.col("current_rate").alias("v"))
    lo, hi = gold._extreme_aggs(d, "current_rate")
    dep, app = gold._move_aggs(d)
    return rows.groupBy(k, SEGMENT).agg(F.min(at).alias("_first"), F.max(at).alias("_last"), lo, hi, dep, app)


def fold(summary: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key the extremes and moves of all of its segments."""
    k, d = spec.k, spec.d
    ordered = Window.partitionBy(k).orderBy(SEGMENT)
    rows = summary.withColumn("_before", F.lag("_last").over(ordered))
    # the change from the segment before to this one's first value, with the moves' own names
    border = rows.withColumns({d: F.col("_first.d"), **_changes(F.col("_first.v"), F.col("_before.v"))})
    dep, app = gold._move_aggs(d)
    border = border.groupBy(k).agg(dep.alias("_b_dep"), app.alias("_b_app"))
    inner = summary.groupBy(k).agg(*[F.min(c).alias(c) for c in ("_lo", "_hi", "_dep", "_app")])
    both = inner.join(border.withColumnRenamed(k, "_k"), F.col(k).eqNullSafe(F.col("_k"))).drop("_k")
    # least skips NULLs, as min does
    return both.select(k, "_lo", "_hi", F.least("_dep", "_b_dep").alias("_dep"), F.least("_app", "_b_app").alias("_app"))


def extremes(folded: DataFrame, spec: SeriesSpec) -> DataFrame:
    """D1 from ``fold``."""
    return folded.select(*gold._extreme_cols(spec.k))


def movements(folded: DataFrame, spec: SeriesSpec) -> DataFrame:
    """D3 from ``fold``."""
    return folded.where(F.col("_dep").isNotNull() & F.col("_app").isNotNull()).select(F.col(spec.k), *gold._move_cols())


def state_schema(spark: SparkSession, series: T.StructType, spec: SeriesSpec) -> T.StructType:
    return summaries(spark.createDataFrame([], series), spec).schema


def apply_batch(updates: DataFrame, silver_path: str, state_path: str, spec: SeriesSpec) -> DataFrame:
    """Merge updates (series and order columns) into silver and its summaries; the folded state.

    Silver and the summaries are partitioned by ``segment``. Reads the touched
    partitions of silver and the summaries, nothing else.
    """
    spark = updates.sparkSession
    k, d, v = spec.series_cols
    columns = list(dict.fromkeys([*spec.series_cols, *spec.order_cols]))
    rows = updates.select(*columns, segment_of(d).alias(SEGMENT))
    where = partitions.merge_rows(rows, silver_path, spec.business_key, spec.order_cols, SEGMENT)
    schema = state_schema(spark, rows.schema, spec)
    # the partition column comes last in a stored table
    schema = T.StructType([f for f in schema if f.name != SEGMENT] + [schema[SEGMENT]])
    if where:
        fresh = partitions.read_partitioned(spark, silver_path, rows.schema).where(partitions._in(SEGMENT, where))
        partitions.replace_partitions(summaries(fresh.select(k, d, v, SEGMENT), spec), state_path, SEGMENT)
    return fold(partitions.read_partitioned(spark, state_path, schema), spec)
