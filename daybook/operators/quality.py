"""Data-quality checks on a keyed daily series, reported as DataFrames.

A whole report comes out of one scan and two shuffles: the input is
aggregated per (key, date), then ``rollup(key)`` yields every key's row plus
one grand-total row in the same aggregate, and a single generator turns those
into report rows (expected keys ride along as empty rows, so missing keys need
no join). Both aggregates are partial before their shuffle, so a hot key or a
hot (key, date) never lands whole in one task, and the grand total reaches its
reducer as one row per map task.

Report rows: ``(check, subject, count, percentage, severity, value)`` with
severity ``ok`` / ``warning`` / ``error``; ``value`` holds a statistic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import parsed_date, percentage
from daybook.spec import SeriesSpec, Thresholds

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("percentage", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


class QualityGateError(ValueError):
    """Raised when a gate finds error rows in a report."""


# ---------------------------------------------------------------- single checks


def _unpivot(one_row: DataFrame, rows: list[Column]) -> DataFrame:
    """Turn the fields of a one-row aggregate into several rows."""
    return one_row.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B1: NULL count and percentage per column, 0 % on an empty table."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_n{i}").alias("null_count"),
            percentage(F.col(f"_n{i}"), "_total").alias("null_percentage"),
        )
        for i, c in enumerate(cols)
    ]
    return _unpivot(one, rows)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """B2: number of key groups holding more than one row, and that number
    as a percentage of all rows (the reference's definition)."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    one = groups.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_count"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
    )
    return one.select(
        "duplicate_count",
        percentage("duplicate_count", "_total").alias("duplicate_percentage"),
    )


def _invalid_value(v: str) -> Column:
    x = F.col(v).cast("double")
    return (x <= 0) | F.isnan(x)


def invalid_values(df: DataFrame, v: str) -> DataFrame:
    """Rows whose value is <= 0 or NaN (a NULL value is not counted)."""
    one = df.agg(F.count_if(_invalid_value(v)).alias("invalid_count"), F.count(F.lit(1)).alias("_t"))
    return one.select("invalid_count", percentage("invalid_count", "_t").alias("invalid_percentage"))


def value_stats(df: DataFrame, v: str, scale: int | None = None) -> DataFrame:
    """Min, max and mean of the value column as doubles.

    A double sum depends on the order rows are added in, which changes with
    partitioning; ``scale`` rounds the mean where equal data must report the
    same digits.
    """
    x = F.col(v).cast("double")
    mean = F.avg(x) if scale is None else F.round(F.avg(x), scale)
    return df.agg(F.min(x).alias("min_value"), F.max(x).alias("max_value"), mean.alias("mean_value"))


def date_validation(df: DataFrame, d: str) -> DataFrame:
    """Rows whose date is not a strict ``yyyy-MM-dd`` (NULL included),
    and the earliest and latest valid date as ``yyyy-MM-dd`` strings."""
    p = parsed_date(d)
    one = df.agg(
        F.count_if(p.isNull()).alias("invalid_dates"),
        F.count(F.lit(1)).alias("_t"),
        F.min(p).alias("_lo"),
        F.max(p).alias("_hi"),
    )
    return one.select(
        "invalid_dates",
        percentage("invalid_dates", "_t").alias("invalid_percentage"),
        F.col("_lo").cast("string").alias("min_date"),
        F.col("_hi").cast("string").alias("max_date"),
    )


def records_per_key(df: DataFrame, k: str, min_expected: int = 100) -> DataFrame:
    """Rows per key and whether the key falls short of ``min_expected``."""
    return (
        df.groupBy(k)
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("below_minimum", F.col("record_count") < F.lit(min_expected))
        .orderBy(k)
    )


def expected_keys_frame(spark, k: str, keys: Sequence[str]) -> DataFrame:
    """Configured key list as a one-column DataFrame (configuration, not data)."""
    return spark.createDataFrame([(x,) for x in keys], T.StructType([T.StructField(k, T.StringType())]))


def missing_keys(df: DataFrame, k: str, expected: DataFrame) -> DataFrame:
    """Expected keys that have no row in ``df``.

    The data side is reduced to its distinct keys (partial aggregate on the
    map side) before the anti join shuffles it.
    """
    present = df.select(F.col(k).cast("string").alias(k)).distinct()
    exp = expected.select(F.col(k).cast("string").alias(k)).distinct()
    return exp.join(present, on=k, how="left_anti")


# ---------------------------------------------------------------- one-scan report


COUNTERS = ("n", "n_null_k", "n_null_d", "n_null_v", "n_invalid_v", "n_bad_d", "n_v")


def _rolled(df: DataFrame, spec: SeriesSpec, expected: DataFrame | None) -> DataFrame:
    """Per-key rows and one grand-total row from a single pass.

    1. ``groupBy(key, date)`` (partial aggregate, shuffle on key+date);
    2. expected keys are added as empty rows;
    3. ``rollup(key)`` (partial aggregate, shuffle on key): grouping id 0
       rows are keys, the grouping id 1 row is the whole table.
    """
    k, d, v = spec.k, spec.d, spec.v
    x = F.nanvl(F.col(v).cast("double"), F.lit(None))  # statistics of the numbers; NaN is counted as invalid
    per_kd = df.groupBy(k, d).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(v).isNull()).alias("n_null_v"),
        F.count_if(_invalid_value(v)).alias("n_invalid_v"),
        F.count(x).alias("n_v"),
        F.sum(x).alias("sum_v"),
        F.min(x).alias("min_v"),
        F.max(x).alias("max_v"),
    )
    n = F.col("n")
    stats = ("sum_v", "min_v", "max_v", "min_d", "max_d")
    # key NULL-ness, date NULL-ness and date validity are constant in a group
    rows = per_kd.select(
        F.col(k).cast("string").alias(k),
        n,
        F.when(F.col(k).isNull(), n).otherwise(F.lit(0)).alias("n_null_k"),
        F.when(F.col(d).isNull(), n).otherwise(F.lit(0)).alias("n_null_d"),
        "n_null_v",
        "n_invalid_v",
        "n_v",
        "sum_v",
        "min_v",
        "max_v",
        parsed_date(d).alias("min_d"),
        parsed_date(d).alias("max_d"),
        F.when(parsed_date(d).isNull(), n).otherwise(F.lit(0)).alias("n_bad_d"),
        F.when(n > 1, F.lit(1)).otherwise(F.lit(0)).alias("dup"),
        F.lit(False).alias("is_expected"),
    )
    if expected is not None:
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(
            expected.select(
                F.col(k).cast("string").alias(k),
                *[zero.alias(c) for c in COUNTERS],
                *[F.lit(None).cast(t).alias(c) for c, t in zip(stats, ("double", "double", "double", "date", "date"))],
                F.lit(0).alias("dup"),
                F.lit(True).alias("is_expected"),
            )
        )
    z = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.rollup(k).agg(
        F.grouping_id().alias("_gid"),
        *[z(c).alias(c) for c in COUNTERS],
        F.sum("sum_v").alias("sum_v"),
        *[F.min(c).alias(c) for c in ("min_v", "min_d")],
        *[F.max(c).alias(c) for c in ("max_v", "max_d")],
        z("dup").alias("dup_groups"),
        F.max("is_expected").alias("is_expected"),
    )


def _row(
    check: str, subject: Column | str, count: Column, pct: Column | None, severity: Column, value: Column | None = None
) -> Column:
    subj = F.lit(subject) if isinstance(subject, str) else subject
    return F.struct(
        F.lit(check).alias("check"),
        subj.cast("string").alias("subject"),
        count.cast("long").alias("count"),
        (pct if pct is not None else F.lit(None)).cast("double").alias("percentage"),
        severity.alias("severity"),
        (value if value is not None else F.lit(None)).cast("double").alias("value"),
    )


def _flag(cond: Column, level: str) -> Column:
    return F.when(cond, F.lit(level)).otherwise(F.lit("ok"))


def _emit(rolled: DataFrame, total_rows: list[Column], key_rows: Column) -> DataFrame:
    """One generator over the rolled-up aggregate: the grand-total row
    expands into the global checks, every key row into its own rows."""
    rows = F.when(F.col("_gid") == 1, F.array(*total_rows)).otherwise(key_rows)
    return rolled.select(F.inline(rows))


def quality_report(
    df: DataFrame,
    spec: SeriesSpec,
    expected: DataFrame | None = None,
    thresholds: Thresholds | None = None,
    scale: int | None = None,
) -> DataFrame:
    """The bronze checks as one report DataFrame (one scan).

    null share over ``max_null_percentage`` -> error; duplicate share over
    ``max_duplicate_percentage`` -> warning; any value <= 0 or NaN -> error;
    any invalid date -> error; a key below ``min_expected_records`` ->
    warning; an expected key without rows -> warning. ``value_stats`` rows hold
    the least, greatest and mean number (the mean rounded to ``scale`` decimals
    if given), the ``date_range`` row the first and last valid date.
    """
    th = thresholds or spec.thresholds
    k, d, v = spec.k, spec.d, spec.v
    if expected is None:
        expected = expected_keys_frame(df.sparkSession, k, spec.expected_keys)
    rolled = _rolled(df, spec, expected)
    n = F.col("n")
    pct = lambda c: percentage(F.col(c), n)
    totals = [
        _row("null_check", col, F.col(src), pct(src), _flag(pct(src) > th.max_null_percentage, "error"))
        for col, src in ((k, "n_null_k"), (d, "n_null_d"), (v, "n_null_v"))
    ]
    totals += [
        _row(
            "duplicate_check",
            f"{k},{d}",
            F.col("dup_groups"),
            pct("dup_groups"),
            _flag(pct("dup_groups") > th.max_duplicate_percentage, "warning"),
        ),
        _row("value_check", v, F.col("n_invalid_v"), pct("n_invalid_v"), _flag(F.col("n_invalid_v") > 0, "error")),
        _row("date_check", d, F.col("n_bad_d"), pct("n_bad_d"), _flag(F.col("n_bad_d") > 0, "error")),
    ]
    ok, n_v = F.lit("ok"), F.col("n_v")
    mean = F.try_divide(F.col("sum_v"), n_v)
    stats = {"min": F.col("min_v"), "max": F.col("max_v"), "mean": mean if scale is None else F.round(mean, scale)}
    totals += [_row("value_stats", name, n_v, None, ok, value) for name, value in stats.items()]
    days = F.concat_ws("..", F.col("min_d").cast("string"), F.col("max_d").cast("string"))
    totals.append(_row("date_range", days, n - F.col("n_bad_d"), None, ok))
    record = _row("record_count", F.col(k), n, None, _flag(n < F.lit(th.min_expected_records), "warning"))
    missing = _row("missing_key", F.col(k), F.lit(0), None, F.lit("warning"))
    # inline(NULL) emits nothing: keys are either present or missing
    per_key = F.when(n > 0, F.array(record)).when(F.col("is_expected"), F.array(missing))
    return _emit(rolled, totals, per_key)


def malformed_row(spark, malformed: int, records: int) -> DataFrame:
    """A report row for records that could not be parsed at all."""
    share = malformed / records * 100.0 if records else 0.0
    row = ("malformed_check", "payload", malformed, share, "error" if malformed else "ok", None)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def outside_window_row(spark, outside: int, records: int) -> DataFrame:
    """A report row for dated records that a load left out, being before its window."""
    share = outside / records * 100.0 if records else 0.0
    row = ("load_window", "records before the window", outside, share, "warning" if outside else "ok", None)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def silver_verdict(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The silver gate's checks; any NULL or duplicate is an error."""
    k, d, v = spec.k, spec.d, spec.v
    rolled = _rolled(df, spec, None)
    n = F.col("n")
    totals = [
        _row("null_check", col, F.col(src), percentage(F.col(src), n), _flag(F.col(src) > 0, "error"))
        for col, src in ((k, "n_null_k"), (d, "n_null_d"), (v, "n_null_v"))
    ]
    totals.append(
        _row(
            "duplicate_check",
            f"{k},{d}",
            F.col("dup_groups"),
            percentage(F.col("dup_groups"), n),
            _flag(F.col("dup_groups") > 0, "error"),
        )
    )
    return _emit(rolled, totals, F.array(_row("record_count", F.col(k), n, None, F.lit("ok"))))


def errors_of(report: DataFrame) -> list[str]:
    """Error rows as messages. A report holds at most one error row per
    global check (record and missing-key rows are never errors), so this
    collect is bounded by the number of checks, not by the data."""
    rows = report.where(F.col("severity") == "error").collect()
    return [f"{r['check']}({r['subject']}): {r['count']}" for r in rows]


def is_valid(report: DataFrame) -> bool:
    return not errors_of(report)


def enforce(report: DataFrame, strict: bool = False) -> bool:
    """Bronze gate: raise only in strict mode; otherwise report validity."""
    errors = errors_of(report)
    if errors and strict:
        raise QualityGateError("data quality validation failed in strict mode: " + "; ".join(errors))
    return not errors


def enforce_verdict(report: DataFrame) -> None:
    """Silver gate: always hard."""
    errors = errors_of(report)
    if errors:
        raise QualityGateError("silver validation failed: " + "; ".join(errors))
