"""A hot key: one key holds about a third of all rows, with many copies of
each of its (key, date) pairs. Results must equal the literal forms, and the
plans must reduce the hot group before it is shuffled."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions.previous import YEAR
from daybook.operators import gold, marts, quality, silver
from daybook.plans import bindings as B
from tests.conftest import SF001, SF01
from tests.literal_forms import extremes_by_rank, moves_by_rank
from tests.helpers import same

HOT = "HOT"


def hot_bronze(spark, sf=SF01):
    b, spec = B.supp_bronze(spark, sf)
    # line numbers 1 and 2 are about a third of lineitem; they all become one key
    return b.withColumn(spec.k, F.when(F.col("l_linenumber") <= 2, F.lit(HOT)).otherwise(F.col(spec.k))), spec


@pytest.fixture(scope="module")
def hot(spark):
    b, spec = hot_bronze(spark)
    b = b.cache()
    yield b, spec
    b.unpersist()


def plan_of(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_holds_a_third_with_copies(hot):
    b, spec = hot
    n, n_hot = b.count(), b.where(F.col(spec.k) == HOT).count()
    assert 0.25 < n_hot / n < 0.45
    per_day = b.where(F.col(spec.k) == HOT).groupBy(spec.d).count()
    assert per_day.agg(F.max("count")).first()[0] > 10


def test_dedup_and_gold_equal_literal_forms_under_skew(hot):
    b, spec = hot
    agg = silver.latest_per_key(b, spec.business_key, spec.order_cols)
    assert same(agg, silver.latest_per_key(b, spec.business_key, spec.order_cols, method="window"))
    s = agg.select(*spec.series_cols).cache()
    try:
        plain = gold.daily_changes(s, spec, stamp=False)
        assert same(plain, gold.daily_changes(s, spec, stamp=False, segment=YEAR))
        assert same(
            gold.historical_extremes(s, spec, stamp=False),
            extremes_by_rank(s, spec),
        )
        ch = gold.daily_changes(s, spec, stamp=False)
        assert same(
            gold.extreme_daily_movements(ch, spec, stamp=False),
            moves_by_rank(ch, spec),
        )
        assert same(marts.biggest_appreciation(s, spec), marts.biggest_appreciation(s, spec, method="window"))
    finally:
        s.unpersist()


def test_hot_group_is_reduced_before_every_shuffle(hot):
    b, spec = hot
    s = B.series_of(b, spec)
    lines = plan_of(gold.executive_summary_from_series(s, spec, stamp=False)).splitlines()
    shuffles = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x and "Reused" not in x]
    # the dedup, above its partial aggregate, and the key, which gets at most
    # one row for each of the key's days
    assert "partial_max" in lines[max(shuffles) + 1]
    report = plan_of(quality.quality_report(b, spec))
    assert report.count("partial_") >= 2


def test_dedup_bounds_a_hot_key_by_its_days(hot):
    b, spec = hot
    copies = b.where(F.col(spec.k) == HOT)
    s = B.series_of(b, spec).where(F.col(spec.k) == HOT)
    first, last = s.agg(F.min(spec.d), F.max(spec.d)).first()
    days = (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days + 1
    # whatever the number of raw copies, the lag's group has a row per day at most
    assert s.count() <= days < copies.count()


def test_segmented_lag_shuffles_only_the_carry(spark):
    # the opt-in for series that are not unique per (key, date)
    b, spec = hot_bronze(spark, SF001)
    s = silver.latest_per_key(b, spec.business_key, spec.order_cols).select(*spec.series_cols)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ch = gold.daily_changes(s, spec, stamp=False, segment=YEAR)
        p = plan_of(ch)
        assert same(ch, gold.daily_changes(s, spec, stamp=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    final = p.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final
    big = [x for x in final.splitlines() if "Exchange" in x and "Reused" not in x]
    assert sum("REPARTITION_BY_COL" in x for x in big) == 1
    assert sum(f"hashpartitioning({spec.k}#" in x for x in big) == 1  # the dedup
    assert "ReusedExchange" in final  # the carry reads the same (key, year) exchange
