"""Every operator run on the test tables, with an independent SQL statement
of the same result for the DuckDB cross-check.

Names follow the operator list; a suffix names a further binding
(``_cust``, ``_supp``, ``_evt``). Run timestamps are left out of the compared
output (they differ on every run); the stamping operators show what must hold
for the stamp beside the data: never null, one value, not before the start.
Means are rounded here (``scale``), because a double sum depends on the order
of its rows.

The SQL side is written from the operator definitions, not generated from
the Spark code: ranking by ``ROW_NUMBER`` (earliest date on ties), ``LAG``,
``NULLIF`` for division by zero and ``GROUP BY`` / ``UNION ALL`` reports.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import gold, marts, quality, silver
from daybook.plans import bindings as B
from daybook.plans import mechanisms
from daybook.sinks import tables as sinks
from daybook.sources import incremental, payload
from daybook.spec import SeriesSpec, Thresholds

Query = Callable[[SparkSession, str], DataFrame]

BINDERS = {
    "ord": B.orders_bronze,
    "cust": B.cust_bronze,
    "supp": B.supp_bronze,
    "evt": B.evt_bronze,
    "dirty": B.dirty_bronze,
}

# Parameters of the registered runs.
WATERMARK_TARGET_BEFORE = "1999-01-01"  # the "already loaded" part of orders
INCREMENTAL_AS_OF = "2000-06-30"
FULL_AS_OF = "2001-08-01"
COVERAGE_START, COVERAGE_END = "1995-01-01", "2001-12-31"
MIN_EXPECTED_CUST = 8
APPEND_SPLIT = "1998-01-01"


def _bronze(name: str, spark: SparkSession, sf: str) -> tuple[DataFrame, SeriesSpec]:
    return BINDERS[name](spark, sf)


def _series(name: str, spark: SparkSession, sf: str) -> tuple[DataFrame, SeriesSpec]:
    b, spec = _bronze(name, spark, sf)
    return B.series_of(b, spec), spec


# ---------------------------------------------------------------- A


def q_payload_flatten(spark: SparkSession, sf: str) -> DataFrame:
    o = B.table(spark, sf, "orders")
    texts = payload.payload_texts(
        o,
        parent={"code": F.col("o_orderpriority"), "currency": F.col("o_orderstatus"), "table": F.lit("A")},
        child={
            "no": F.col("o_orderkey").cast("string"),
            "effectiveDate": B.day_string("o_orderdate"),
            "mid": F.col("o_totalprice"),
        },
    )
    return payload.flatten_payload(payload.parse_payloads(texts))


def q_declared_schema_read(spark: SparkSession, sf: str) -> DataFrame:
    o = B.table(spark, sf, "orders")
    rec = F.struct(
        F.col("o_custkey").cast("string").alias("currency_code"),
        F.col("o_orderstatus").alias("currency_name"),
        F.lit("A").alias("table"),
        F.col("o_orderkey").cast("string").alias("no"),
        B.dirty_date(o).alias("effectiveDate"),
        B.dirty_value(o).alias("mid"),
    )
    texts = o.select(F.to_json(rec).alias("value"))
    return payload.declared_status(payload.parse_declared(texts))


def q_high_watermark(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return incremental.high_watermark(b, spec.d)


def q_incremental_batch(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    target = b.where(F.col(spec.d) < WATERMARK_TARGET_BEFORE)
    return incremental.incremental_batch(b, spec.d, INCREMENTAL_AS_OF, target=target)


def q_incremental_batch_full(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return incremental.incremental_batch(b, spec.d, FULL_AS_OF, target=None, years_back=5)


def q_load_window_coverage(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("cust", spark, sf)
    keys = B.customer_keys(spark, sf, spec.k)
    return incremental.load_window_coverage(b, spec.k, spec.d, keys, COVERAGE_START, COVERAGE_END)


def _stamp_shown(stamp: Callable[[DataFrame], DataFrame], df: DataFrame, col: str) -> DataFrame:
    """The rows of ``df`` with what must hold for the stamp instead of its value."""
    start = dt.datetime.now(dt.UTC)
    out = stamp(df)
    one = out.agg(F.count_distinct(col)).scalar() <= 1  # the same query, hence the same stamp
    return out.select(*df.columns, F.col(col).isNotNull().alias("stamped"), one.alias("one_stamp"), (F.col(col) >= F.lit(start)).alias("after_start"))


def q_stamp_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    b, _ = _bronze("ord", spark, sf)
    return _stamp_shown(payload.stamp_ingestion, b, payload.INGESTION_TS)


# ---------------------------------------------------------------- B


def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("dirty", spark, sf)
    return quality.null_profile(b, spec.series_cols)


def q_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return quality.duplicate_keys(b, spec.business_key)


def q_invalid_values(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("dirty", spark, sf)
    return quality.invalid_values(b, spec.v)


def q_value_stats(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return quality.value_stats(b, spec.v, scale=6)


def q_date_validation(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("dirty", spark, sf)
    return quality.date_validation(b, spec.d)


def q_records_per_key_cust(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("cust", spark, sf)
    return quality.records_per_key(b, spec.k, MIN_EXPECTED_CUST)


def q_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("evt", spark, sf)
    return quality.missing_keys(b, spec.k, B.customer_keys(spark, sf, spec.k))


def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("dirty", spark, sf)
    spec = spec.with_(thresholds=Thresholds(min_expected_records=MIN_EXPECTED_CUST))
    return quality.quality_report(b, spec, expected=B.customer_keys(spark, sf, spec.k), scale=6)


def q_silver_verdict(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("ord", spark, sf)
    return quality.silver_verdict(s, spec)


def q_silver_verdict_bronze(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return quality.silver_verdict(b, spec)


# ---------------------------------------------------------------- C


def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return silver.latest_per_key(b, spec.business_key, spec.order_cols)


def q_latest_per_key_supp(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("supp", spark, sf)
    return silver.latest_per_key(b, spec.business_key, spec.order_cols)


def q_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return silver.dedup_stats(b, spec.business_key)


def q_prune_columns(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return silver.prune_columns(b, spec.series_cols)


def q_stamp_processing(spark: SparkSession, sf: str) -> DataFrame:
    s, _ = _series("ord", spark, sf)
    return _stamp_shown(silver.stamp_processing, s, silver.PROCESSING_TS)


def _silver_series(name: str, spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze(name, spark, sf)
    out = silver.build_silver(b, spec, sinks.scratch_path(spark, f"silver-{name}"))
    return out.drop(silver.PROCESSING_TS)


def q_silver_series(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_series("ord", spark, sf)


def q_silver_series_supp(spark: SparkSession, sf: str) -> DataFrame:
    return _silver_series("supp", spark, sf)


# ---------------------------------------------------------------- D


def _extremes(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        s, spec = _series(name, spark, sf)
        return gold.historical_extremes(s, spec, stamp=False)

    return q


def _changes(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        s, spec = _series(name, spark, sf)
        return gold.daily_changes(s, spec, stamp=False)

    return q


def _moves(name: str) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        s, spec = _series(name, spark, sf)
        return gold.extreme_daily_movements(gold.daily_changes(s, spec, stamp=False), spec, stamp=False)

    return q


def q_executive_summary(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("cust", spark, sf)
    return gold.executive_summary_from_series(s, spec, stamp=False)


def q_executive_summary_tables(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("cust", spark, sf)
    ext = gold.historical_extremes(s, spec, stamp=False)
    mov = gold.extreme_daily_movements(gold.daily_changes(s, spec, stamp=False), spec, stamp=False)
    return gold.executive_summary(ext, mov, spec)


def q_gold_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("cust", spark, sf)
    ch = gold.daily_changes(s, spec, stamp=False)
    return gold.gold_record_counts(
        gold.historical_extremes(s, spec, stamp=False), ch, gold.extreme_daily_movements(ch, spec, stamp=False)
    )


# ---------------------------------------------------------------- E


def _mart(name: str, fn) -> Query:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        s, spec = _series(name, spark, sf)
        return fn(s, spec)

    return q


def q_rate_line_series(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return marts.rate_line_series(b, spec, scale=4)


def q_series_row_count(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return marts.series_row_count(b, [spec.k])


def q_series_row_count_by_day(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    return marts.series_row_count(b, [spec.k, spec.d])


# ---------------------------------------------------------------- F


def q_append_evolving(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("ord", spark, sf)
    path = sinks.scratch_path(spark, "append")
    early = F.col(spec.d) < APPEND_SPLIT
    sinks.append_table(s.where(early), path)
    sinks.append_table(s.where(~early).withColumn("o_orderkey_hint", F.length(spec.d)), path)
    return sinks.read_table(spark, path, merge=True)


def q_overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    path = sinks.scratch_path(spark, "overwrite")
    sinks.overwrite_table(b, path)
    # replace the table with a plan that reads the table itself
    current = sinks.read_table(spark, path)
    return sinks.overwrite_table(B.series_of(current, spec), path)


def q_create_or_replace_table_as(spark: SparkSession, sf: str) -> DataFrame:
    s, spec = _series("ord", spark, sf)
    path = sinks.scratch_path(spark, "ctas")
    name = "daybook_" + path.rsplit("-", 1)[-1]
    sinks.create_or_replace_table_as(s, name, f"{path}/first")
    return sinks.create_or_replace_table_as(gold.historical_extremes(s, spec, stamp=False), name, f"{path}/second")


def q_create_or_replace_view(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.create_or_replace_view(q_executive_summary_tables(spark, sf), "executive_summary")


def q_write_verification(spark: SparkSession, sf: str) -> DataFrame:
    b, spec = _bronze("ord", spark, sf)
    path = sinks.scratch_path(spark, "verify")
    early = F.col(spec.d) < APPEND_SPLIT
    sinks.append_table(b.where(early), path)
    return sinks.verify_write(b.where(~early), path)


QUERIES: dict[str, Query] = {
    # A
    "payload_flatten": q_payload_flatten,
    "declared_schema_read": q_declared_schema_read,
    "high_watermark": q_high_watermark,
    "incremental_batch": q_incremental_batch,
    "incremental_batch_full": q_incremental_batch_full,
    "load_window_coverage": q_load_window_coverage,
    "stamp_ingestion": q_stamp_ingestion,
    # B
    "null_profile": q_null_profile,
    "duplicate_keys": q_duplicate_keys,
    "invalid_values": q_invalid_values,
    "value_stats": q_value_stats,
    "date_validation": q_date_validation,
    "records_per_key_cust": q_records_per_key_cust,
    "missing_keys": q_missing_keys,
    "quality_report": q_quality_report,
    "silver_verdict": q_silver_verdict,
    "silver_verdict_bronze": q_silver_verdict_bronze,
    # C
    "latest_per_key": q_latest_per_key,
    "latest_per_key_supp": q_latest_per_key_supp,
    "dedup_stats": q_dedup_stats,
    "prune_columns": q_prune_columns,
    "stamp_processing": q_stamp_processing,
    "silver_series": q_silver_series,
    "silver_series_supp": q_silver_series_supp,
    # D
    "historical_extremes": _extremes("ord"),
    "historical_extremes_cust": _extremes("cust"),
    "historical_extremes_supp": _extremes("supp"),
    "historical_extremes_evt": _extremes("evt"),
    "daily_changes_cust": _changes("cust"),
    "daily_changes_supp": _changes("supp"),
    "daily_changes_evt": _changes("evt"),
    "extreme_daily_movements_cust": _moves("cust"),
    "extreme_daily_movements_supp": _moves("supp"),
    "extreme_daily_movements_evt": _moves("evt"),
    "executive_summary": q_executive_summary,
    "executive_summary_tables": q_executive_summary_tables,
    "gold_record_counts": q_gold_record_counts,
    # E
    "biggest_appreciation": _mart("cust", marts.biggest_appreciation),
    "biggest_depreciation": _mart("cust", marts.biggest_depreciation),
    "biggest_appreciation_supp": _mart("supp", marts.biggest_appreciation),
    "highest_rates": _mart("ord", marts.highest_rates),
    "lowest_rates": _mart("ord", marts.lowest_rates),
    "highest_rates_evt": _mart("evt", marts.highest_rates),
    "rate_line_series": q_rate_line_series,
    "series_row_count": q_series_row_count,
    "series_row_count_by_day": q_series_row_count_by_day,
    # F
    "append_evolving": q_append_evolving,
    "overwrite_table": q_overwrite_table,
    "create_or_replace_table_as": q_create_or_replace_table_as,
    "create_or_replace_view": q_create_or_replace_view,
    "write_verification": q_write_verification,
}

# the mechanisms beyond the inventory: joins in time, merged tables, incremental gold
QUERIES.update(mechanisms.QUERIES)
