"""Joins in time, merged tables and incremental gold on the test tables, with the DuckDB statement of each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import incremental_gold
from daybook.operators.temporal import asof_join, interval_join
from daybook.plans import bindings as B
from daybook.sinks import partitions
from daybook.sinks import tables as sinks

Query = Callable[[SparkSession, str], DataFrame]


def _day(c: str):
    return F.col(c).cast("date").cast("string")


# ---------------------------------------------------------------- as-of join


def q_asof_events_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with its user's latest earlier order."""
    events = B.table(spark, sf, "events").select("event_id", "user_id", "ts")
    orders = B.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    out = asof_join(events, orders, [("user_id", "o_custkey")], "ts", "o_orderdate", {"order_key": "o_orderkey", "order_value": "o_totalprice"}, tie=["o_orderkey"])
    return out.select("event_id", "user_id", "order_key", "order_value")


def q_asof_previous_order(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with its customer's latest strictly earlier order of the last 90 days."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = asof_join(
        orders, orders, [("o_custkey", "o_custkey")], "o_orderdate", "o_orderdate", {"previous_key": "o_orderkey", "previous_value": "o_totalprice"},
        tie=["o_orderkey"], exact=False, within=dt.timedelta(days=90),
    )
    return out.select("o_orderkey", "previous_key", "previous_value")


#: Rows of a segment of one event type: few types hold all rows, so each is cut.
EVENT_SEGMENT = 500


def q_asof_next_event(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with the next strictly later event of its type within two hours (hot keys, cut into segments)."""
    events = B.table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    out = asof_join(
        events, events, [("event_type", "event_type")], "ts", "ts", {"next_id": "event_id", "next_value": "value"},
        tie=["event_id"], direction="forward", exact=False, within=dt.timedelta(hours=2), rows_per_segment=EVENT_SEGMENT, cuts=31,
    )
    return out.select("event_id", "next_id", "next_value")


# ---------------------------------------------------------------- overlapping spans


def q_interval_nation_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Per nation: pairs of a customer's order span and a supplier's shipping span that overlap, and the days they share."""
    t = lambda name, *cols: B.table(spark, sf, name).select(*cols)
    spans = t("orders", "o_custkey", "o_orderdate").groupBy("o_custkey").agg(F.min("o_orderdate").alias("c_from"), F.max("o_orderdate").alias("c_to"))
    customers = t("customer", "c_custkey", "c_nationkey").join(spans, F.col("c_custkey") == F.col("o_custkey"))
    spans = t("lineitem", "l_suppkey", "l_shipdate").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("s_from"), F.max("l_shipdate").alias("s_to"))
    suppliers = t("supplier", "s_suppkey", "s_nationkey").join(spans, F.col("s_suppkey") == F.col("l_suppkey"))
    pairs = interval_join(customers, suppliers, [("c_nationkey", "s_nationkey")], ("c_from", "c_to"), ("s_from", "s_to"), dt.timedelta(days=180))
    shared = F.datediff(F.least("l.c_to", "r.s_to"), F.greatest("l.c_from", "r.s_from"))
    return pairs.groupBy(F.col("l.c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("pairs"), F.sum(shared).cast("bigint").alias("shared_days"))


def q_interval_open_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer: pairs of orders that were open (order date to last shipment) at the same time."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shipped = B.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    open_ = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_custkey", "o_orderdate", "shipped")
    pairs = interval_join(open_, open_, [("o_custkey", "o_custkey")], ("o_orderdate", "shipped"), ("o_orderdate", "shipped"), dt.timedelta(days=30))
    pairs = pairs.where("l.o_orderkey < r.o_orderkey")
    return pairs.groupBy(F.col("l.o_custkey").alias("o_custkey")).agg(F.count(F.lit(1)).alias("open_pairs"))


# ---------------------------------------------------------------- merged silver, incremental gold


def _batches(spark: SparkSession, sf: str) -> tuple[list[DataFrame], object]:
    """Customers' orders as a first load, late corrections and a repeated batch."""
    bronze, spec = B.cust_bronze(spark, sf)
    key = F.col("o_orderkey")
    first, late = bronze.where(key % 3 != 0), bronze.where(key % 3 == 0)
    return [first, late.where(key % 2 == 0), late.where(key % 2 == 1), late.where(key % 2 == 0)], spec


def q_silver_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Silver after corrections, each batch merged into the months it touches."""
    batches, spec = _batches(spark, sf)
    path = sinks.scratch_path(spark, "merge")
    for b in batches:
        rows = b.withColumn(incremental_gold.SEGMENT, incremental_gold.segment_of(spec.d))
        partitions.merge_rows(rows, path, spec.business_key, spec.order_cols, incremental_gold.SEGMENT)
    return partitions.read_partitioned(spark, path, rows.schema).select(*spec.series_cols)


def _incremental(spark: SparkSession, sf: str) -> tuple[DataFrame, object]:
    batches, spec = _batches(spark, sf)
    path = sinks.scratch_path(spark, "incremental")
    for b in batches[:3]:
        folded = incremental_gold.apply_batch(b, f"{path}/silver", f"{path}/state", spec)
    return folded, spec


def q_incremental_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return incremental_gold.extremes(*_incremental(spark, sf))


def q_incremental_movements(spark: SparkSession, sf: str) -> DataFrame:
    return incremental_gold.movements(*_incremental(spark, sf))


QUERIES: dict[str, Query] = {
    "asof_events_orders": q_asof_events_orders,
    "asof_previous_order": q_asof_previous_order,
    "asof_next_event": q_asof_next_event,
    "interval_nation_activity": q_interval_nation_activity,
    "interval_open_orders": q_interval_open_orders,
    "silver_merge": q_silver_merge,
    "incremental_extremes": q_incremental_extremes,
    "incremental_movements": q_incremental_movements,
}

#: By plain pairs and rankings; the last three are the statements of the full rebuilds.
SQL: dict[str, str] = {
    "asof_events_orders": """
SELECT event_id, user_id, o_orderkey AS order_key, o_totalprice AS order_value
FROM events LEFT JOIN orders ON o_custkey = user_id AND o_orderdate <= ts
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "asof_previous_order": """
SELECT a.o_orderkey, b.o_orderkey AS previous_key, b.o_totalprice AS previous_value
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate < a.o_orderdate AND b.o_orderdate >= a.o_orderdate - INTERVAL 90 DAY
QUALIFY row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_orderdate DESC, b.o_orderkey DESC) = 1""",
    "asof_next_event": """
SELECT a.event_id, b.event_id AS next_id, b.value AS next_value
FROM events a LEFT JOIN events b ON a.event_type = b.event_type AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 2 HOUR
QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.ts, b.event_id DESC) = 1""",
    "interval_nation_activity": """
WITH c AS (
  SELECT c_custkey, c_nationkey AS nation, min(o_orderdate) AS a, max(o_orderdate) AS b
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
s AS (
  SELECT s_suppkey, s_nationkey AS nation, min(l_shipdate) AS a, max(l_shipdate) AS b
  FROM supplier JOIN lineitem ON s_suppkey = l_suppkey GROUP BY ALL)
SELECT c.nation, count(*) AS pairs, CAST(sum(date_diff('day', greatest(c.a, s.a), least(c.b, s.b))) AS BIGINT) AS shared_days
FROM c JOIN s ON c.nation = s.nation AND c.a <= s.b AND s.a <= c.b GROUP BY c.nation""",
    "interval_open_orders": """
WITH o AS (
  SELECT o_orderkey, o_custkey, o_orderdate AS a, max(l_shipdate) AS b
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL HAVING max(l_shipdate) >= o_orderdate)
SELECT x.o_custkey, count(*) AS open_pairs
FROM o x JOIN o y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey AND x.a <= y.b AND y.a <= x.b
GROUP BY x.o_custkey""",
}
