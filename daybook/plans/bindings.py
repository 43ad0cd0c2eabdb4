"""Bindings of the test tables to keyed daily series.

Each binding reads one table with only the columns it needs (column pruning
reaches the Parquet scan) and returns ``(bronze_frame, spec)``. Dates are the
calendar day of the source timestamp as a ``yyyy-MM-dd`` string (a
timezone-free cast). Values are used as stored.

| binding  | table    | key             | date        | value           | newest first by |
|----------|----------|-----------------|-------------|-----------------|-----------------|
| ord      | orders   | o_orderpriority | o_orderdate | o_totalprice    | o_orderkey |
| cust     | orders   | o_custkey       | o_orderdate | o_totalprice    | o_orderkey |
| supp     | lineitem | l_suppkey       | l_shipdate  | l_extendedprice | l_orderkey, l_linenumber, l_partkey, l_extendedprice |
| evt      | events   | user_id         | ts          | value           | event_id |
| dirty    | orders   | o_custkey       | (faulted)   | (faulted)       | o_orderkey |

``dirty`` injects faults into every row by a fixed rule on ``o_orderkey``
(NULL / negative / NaN values, impossible / NULL dates); it keeps all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.spec import SeriesSpec, Thresholds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_string(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date").cast("string")


def orders_bronze(spark: SparkSession, sf_dir: str, key: str = "o_orderpriority") -> tuple[DataFrame, SeriesSpec]:
    o = table(spark, sf_dir, "orders").select(key, "o_orderdate", "o_totalprice", "o_orderkey")
    df = o.select(
        F.col(key).cast("string").alias(key),
        day_string("o_orderdate").alias("o_orderdate"),
        F.col("o_totalprice"),
        F.col("o_orderkey"),
    )
    spec = SeriesSpec(k=key, d="o_orderdate", v="o_totalprice", order_cols=("o_orderkey",), expected_keys=())
    return df, spec


def cust_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    return orders_bronze(spark, sf_dir, key="o_custkey")


SUPP_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def supp_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"
    )
    df = li.select(
        F.col("l_suppkey").cast("string").alias("l_suppkey"),
        day_string("l_shipdate").alias("l_shipdate"),
        "l_extendedprice",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )
    spec = SeriesSpec(k="l_suppkey", d="l_shipdate", v="l_extendedprice", order_cols=SUPP_ORDER, expected_keys=())
    return df, spec


def evt_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_id")
    df = ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        day_string("ts").alias("ts"),
        "value",
        "event_id",
    )
    spec = SeriesSpec(k="user_id", d="ts", v="value", order_cols=("event_id",), expected_keys=())
    return df, spec


# The fault-injection rule of the dirty binding (first match wins).
DIRTY_VALUE_NULL, DIRTY_VALUE_NEG, DIRTY_VALUE_NAN = 97, 101, 103
DIRTY_DATE_BAD, DIRTY_DATE_NULL = 107, 109
DIRTY_BAD_DATE = "2024-13-40"


def dirty_value(o: DataFrame) -> Column:
    key = F.col("o_orderkey")
    hit = lambda m: (key % F.lit(m)) == 0
    return (
        F.when(hit(DIRTY_VALUE_NULL), F.lit(None).cast("double"))
        .when(hit(DIRTY_VALUE_NEG), -F.col("o_totalprice"))
        .when(hit(DIRTY_VALUE_NAN), F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
    )


def dirty_date(o: DataFrame) -> Column:
    key = F.col("o_orderkey")
    hit = lambda m: (key % F.lit(m)) == 0
    return (
        F.when(hit(DIRTY_DATE_BAD), F.lit(DIRTY_BAD_DATE))
        .when(hit(DIRTY_DATE_NULL), F.lit(None).cast("string"))
        .otherwise(day_string("o_orderdate"))
    )


def dirty_bronze(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SeriesSpec]:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    df = o.select(
        F.col("o_custkey").cast("string").alias("o_custkey"),
        dirty_date(o).alias("o_orderdate"),
        dirty_value(o).alias("o_totalprice"),
        F.col("o_orderkey"),
    )
    spec = SeriesSpec(k="o_custkey", d="o_orderdate", v="o_totalprice", order_cols=("o_orderkey",), expected_keys=())
    return df, spec


def customer_keys(spark: SparkSession, sf_dir: str, k: str = "o_custkey") -> DataFrame:
    """All customer keys, named like the series key (expected-key list)."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias(k))


def series_of(bronze: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Silver series of a binding (dedup + prune), without the stamp."""
    from daybook.operators.silver import latest_per_key

    return latest_per_key(bronze, spec.business_key, spec.order_cols).select(*spec.series_cols)


def cust_thresholds(min_expected: int = 8) -> Thresholds:
    return Thresholds(min_expected_records=min_expected)
