"""Aggregate forms equal the literal ranking forms; fused summary equals the
join of the stored gold tables; properties of the operators."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.functions.previous import YEAR, with_previous_value
from daybook.operators import gold, marts, silver
from daybook.plans import bindings as B
from daybook.sources import incremental
from tests.conftest import SF01
from tests.helpers import SPEC, same, series
from tests.literal_forms import extremes_by_rank, moves_by_rank

BINDS = {"ord": B.orders_bronze, "cust": B.cust_bronze, "supp": B.supp_bronze, "evt": B.evt_bronze}


@pytest.fixture(scope="module")
def frames(spark):
    out = {}
    for name, fn in BINDS.items():
        b, spec = fn(spark, SF01)
        b = b.cache()
        out[name] = (b, B.series_of(b, spec).cache(), spec)
    yield out
    for b, s, _ in out.values():
        b.unpersist()
        s.unpersist()


@pytest.mark.parametrize("name", ["ord", "supp"])
def test_dedup_forms_agree(frames, name):
    b, _, spec = frames[name]
    agg = silver.latest_per_key(b, spec.business_key, spec.order_cols)
    win = silver.latest_per_key(b, spec.business_key, spec.order_cols, method="window")
    assert same(agg, win)


@pytest.mark.parametrize("name", ["ord", "cust", "supp", "evt"])
def test_extremes_forms_agree(frames, name):
    _, s, spec = frames[name]
    assert same(
        gold.historical_extremes(s, spec, stamp=False),
        extremes_by_rank(s, spec),
    )


@pytest.mark.parametrize("name", ["cust", "supp", "evt"])
def test_moves_forms_agree(frames, name):
    _, s, spec = frames[name]
    ch = gold.daily_changes(s, spec, stamp=False)
    assert same(
        gold.extreme_daily_movements(ch, spec, stamp=False),
        moves_by_rank(ch, spec),
    )


@pytest.mark.parametrize(
    "fn", [marts.biggest_appreciation, marts.biggest_depreciation, marts.highest_rates, marts.lowest_rates]
)
def test_mart_forms_agree(frames, fn):
    _, s, spec = frames["cust"]
    assert same(fn(s, spec), fn(s, spec, method="window"))


def test_fused_summary_equals_join_of_tables(frames):
    _, s, spec = frames["cust"]
    ch = gold.daily_changes(s, spec, stamp=False)
    joined = gold.executive_summary(
        gold.historical_extremes(s, spec, stamp=False), gold.extreme_daily_movements(ch, spec, stamp=False), spec
    )
    fused = gold.executive_summary_from_series(s, spec, stamp=False)
    assert fused.columns == joined.columns
    assert same(fused, joined)


def test_low_not_above_high_and_changes_telescope(frames):
    _, s, spec = frames["supp"]
    ext = gold.historical_extremes(s, spec, stamp=False)
    assert ext.where(F.col("lowest_rate") > F.col("highest_rate")).count() == 0
    ch = gold.daily_changes(s, spec, stamp=False)
    k, d, v = spec.series_cols
    per_key = ch.groupBy(k).agg(
        F.sum("daily_change_absolute").alias("total"),
        F.max_by("current_rate", d).alias("last"),
        F.min_by("current_rate", d).alias("first"),
    )
    off = per_key.where(F.abs(F.col("total") - (F.col("last") - F.col("first"))) > 1e-6 * F.abs(F.col("last")) + 1e-6)
    assert off.count() == 0


def test_d3_keys_within_e1_keys(frames):
    _, s, spec = frames["cust"]
    d3 = gold.extreme_daily_movements(gold.daily_changes(s, spec, stamp=False), spec, stamp=False).select(spec.k)
    e1 = marts.biggest_appreciation(s, spec).select(F.col("Currency").alias(spec.k))
    assert d3.exceptAll(e1).count() == 0
    assert e1.count() >= d3.count()


def test_dedup_is_idempotent_and_partition_independent(frames):
    b, _, spec = frames["ord"]
    once = silver.latest_per_key(b, spec.business_key, spec.order_cols)
    twice = silver.latest_per_key(once, spec.business_key, spec.order_cols)
    shuffled = silver.latest_per_key(b.repartition(13).orderBy(F.rand(7)), spec.business_key, spec.order_cols)
    assert same(once, twice) and same(once, shuffled)


def test_incremental_twice_adds_nothing(frames):
    b, _, spec = frames["ord"]
    target = b.where(F.col(spec.d) < "1999-01-01")
    first = incremental.incremental_batch(b, spec.d, "2001-12-31", target=target)
    loaded = target.unionByName(first)
    assert incremental.incremental_batch(b, spec.d, "2001-12-31", target=loaded).count() == 0
    assert loaded.count() == b.count()


values = st.one_of(st.floats(allow_nan=True, allow_infinity=True, width=64), st.none())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 6), values), min_size=1, max_size=14))
def test_struct_ordering_matches_ranking(spark, rows):
    # one row per (key, day), arbitrary values incl. NaN, infinities, NULL
    seen, data = set(), []
    for k, day, v in rows:
        if (k, day) not in seen:
            seen.add((k, day))
            data.append((k, f"2024-01-{day:02d}", v))
    s = series(spark, data)
    assert same(
        gold.historical_extremes(s, SPEC, stamp=False),
        extremes_by_rank(s, SPEC),
    )
    ch = gold.daily_changes(s, SPEC, stamp=False)
    assert same(
        gold.extreme_daily_movements(ch, SPEC, stamp=False),
        moves_by_rank(ch, SPEC),
    )
    for fn in (marts.biggest_appreciation, marts.biggest_depreciation, marts.highest_rates, marts.lowest_rates):
        assert same(fn(s, SPEC), fn(s, SPEC, method="window"))


days = st.one_of(st.none(), st.builds(lambda y, doy: f"{y}-{1 + doy // 28:02d}-{1 + doy % 28:02d}",
                                      st.integers(2019, 2024), st.integers(0, 335)))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), days, values), min_size=1, max_size=30))
def test_segmented_lag_equals_plain_lag(spark, rows):
    # one row per (key, day) as after dedup; keys and days may be NULL, years may be empty
    seen, data = set(), []
    for k, d, v in rows:
        if (k, d) not in seen:
            seen.add((k, d))
            data.append((k, d, v))
    s = series(spark, data)
    split = with_previous_value(s, "k", "d", "v", "p", segment=YEAR)
    plain = with_previous_value(s, "k", "d", "v", "p")
    assert split.columns == plain.columns
    assert same(split, plain)
