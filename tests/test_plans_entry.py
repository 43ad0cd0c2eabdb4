"""Physical plan shapes, and the driver contract (entry / queries / SQL)."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from daybook.operators import gold, silver
from daybook.plans import bindings as B
from daybook.plans import registry as R
from daybook.sources import incremental
from tests.conftest import SF001


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_shuffles_twice_and_joins_nothing(spark):
    df = R.q_executive_summary(spark, SF001)
    df.collect()  # final adaptive plan
    p = plan_of(df).split("== Initial Plan ==")[0]
    shuffles = [x for x in p.splitlines() if "Exchange" in x and "AQEShuffleRead" not in x]
    assert len(shuffles) == 2  # the dedup on (key, date), then the key for the lag and the picks
    assert "partial_max" in p  # the dedup aggregates before its shuffle
    assert "Join" not in p and "CartesianProduct" not in p


def test_silver_reads_only_the_series_and_its_order(spark, tmp_dir):
    b, spec = B.supp_bronze(spark, SF001)
    for c in ("name", "table", "no"):
        b = b.withColumn(c, F.lit("x"))
    b.write.parquet(tmp_dir)
    p = plan_of(silver.silver_frame(spark.read.parquet(tmp_dir), spec))
    read = re.search(r"FileScan parquet \[([^\]]*)\]", p)[1]
    assert sorted(x.split("#")[0] for x in read.split(",")) == sorted({*spec.series_cols, *spec.order_cols})


def test_extremes_aggregate_form_has_no_window_or_join(spark):
    b, spec = B.cust_bronze(spark, SF001)
    p = plan_of(gold.historical_extremes(B.series_of(b, spec), spec, stamp=False))
    assert "Window" not in p and "Join" not in p
    assert "partial_min" in p


def test_scans_read_only_needed_columns(spark):
    p = plan_of(R.QUERIES["historical_extremes"](spark, SF001))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in p
    assert "o_custkey" not in p


def test_watermark_filter_reaches_parquet_scan(spark, tmp_dir):
    # a stored string date column: the batch bounds are pushed as literals
    b, spec = B.orders_bronze(spark, SF001)
    b.write.parquet(tmp_dir)
    stored = spark.read.parquet(tmp_dir)
    batch = incremental.incremental_batch(stored, spec.d, "2000-06-30", watermark="1998-12-31")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan_of(batch)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(o_orderdate,1998-12-31)" in p and "LessThanOrEqual(o_orderdate,2000-06-30)" in p


def test_quality_report_is_one_scan(spark):
    p = plan_of(R.q_quality_report(spark, SF001))
    assert p.count("orders.parquet") == 1 and p.count("customer.parquet") == 1
    needed = [x for x in p.splitlines() if "Exchange hashpartitioning" in x and "ENSURE_REQUIREMENTS" in x]
    assert len(needed) == 2
    assert "Join" not in p


def test_coverage_uses_no_cross_product(spark):
    p = plan_of(R.q_load_window_coverage(spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "o_custkey" and "volatility_percentage" in df.columns


def test_every_query_has_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(R.QUERIES) <= set(s)
    assert len(R.QUERIES) == 51


@pytest.mark.parametrize("name", sorted(R.QUERIES))
def test_query_matches_sql_at_smoke_scale(spark, name):
    """Spark result equals the DuckDB statement on sf0.001 (order-insensitive)."""
    df = E.queries()[name](spark, SF001)
    rows = df.collect()
    sql = E.oracle_sql()[name]
    con = duckdb.connect()
    for t in ("orders", "lineitem", "events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t)}.parquet')")
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]

    def key(r):
        return tuple("nan" if isinstance(x, float) and x != x else repr(x) for x in r)

    duck = sorted(key(tuple(r[i] for i in idx)) for r in res.fetchall())
    mine = sorted(key(tuple(r)) for r in rows)
    assert mine == duck
