"""As-of and interval joins, merged partitions and incremental gold against plain definitions."""

from __future__ import annotations

import datetime as dt
import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import gold, incremental_gold, silver
from daybook.operators.temporal import asof_join, interval_join
from daybook.sinks import partitions
from daybook.sinks import tables as sinks
from daybook.spec import SeriesSpec
from tests.helpers import rows_of

# ---------------------------------------------------------------- as-of


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def _asof(left, right, direction, exact, within):
    """(left id, tie, value) of each left row's match; rows are (id, key, time) and (key, time, tie, value)."""
    out = []
    for i, k, t in left:
        best = None
        for rk, rt, o, v in right:
            if None in (k, t, rk, rt) or rk != k:
                continue
            gap = t - rt if direction == "backward" else rt - t
            if gap < 0 or (gap == 0 and not exact) or (within is not None and gap > within):
                continue
            # None sorts below every value
            cand = (-gap, (o is not None, o or 0), (v is not None, v or 0.0), o, v)
            best = cand if best is None or cand[:3] > best[:3] else best
        out.append((i, *(best[3:] if best else (None, None))))
    return sorted(out, key=repr)


KEYS, TIMES = st.sampled_from([None, "a", "a", "a", "b"]), st.one_of(st.none(), st.integers(-6, 12))


@settings(max_examples=14, deadline=None)
@given(
    st.lists(st.tuples(KEYS, TIMES), max_size=25),
    st.lists(st.tuples(KEYS, TIMES, st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from([1.0, 2.5]))), max_size=25),
    st.sampled_from(["backward", "forward"]), st.booleans(), st.sampled_from([None, 0, 3]), st.sampled_from([1, 4, 10**6]),
)
def test_asof_join_equals_the_definition(spark, left, right, direction, exact, within, segment):
    left = [(i, k, t) for i, (k, t) in enumerate(left)]
    ldf = spark.createDataFrame([(*r, "c!") for r in left], "id int, k string, t bigint, seg string").repartition(2)
    rdf = spark.createDataFrame(right, "k string, t bigint, o int, v double").repartition(2)
    out = asof_join(ldf, rdf, [("k", "k")], "t", "t", {"mo": "o", "mv": "v"}, tie=["o"], direction=direction, exact=exact, within=within, rows_per_segment=segment, cuts=5)
    assert out.columns == ["id", "k", "t", "seg", "mo", "mv"]
    assert sorted((tuple(r) for r in out.select("id", "mo", "mv").collect()), key=repr) == _asof(left, right, direction, exact, within)


def test_asof_join_of_dates_timestamps_and_two_keys(spark):
    left = spark.createDataFrame([(1, "x", dt.date(2024, 1, 3)), (1, "y", dt.date(2024, 1, 3)), (2, "x", dt.date(2023, 1, 1))], "a int, b string, d date")
    right = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1), 5.0), (1, "x", dt.date(2024, 1, 4), 6.0), (1, None, dt.date(2024, 1, 1), 7.0)], "ra bigint, rb string, rd date, v double")
    out = asof_join(left, right, [("a", "ra"), ("b", "rb")], "d", "rd", {"v": "v"}, within=dt.timedelta(days=2))
    assert rows_of(out, "a", "b", "v") == [(1, "x", 5.0), (1, "y", None), (2, "x", None)]
    near = asof_join(left, right, [("a", "ra"), ("b", "rb")], "d", "rd", {"v": "v"}, within=dt.timedelta(days=1))
    assert rows_of(near.where("b = 'x' and a = 1"), "v") == [(None,)]
    stamps = asof_join(left.withColumn("d", F.col("d").cast("timestamp")), right.withColumn("rd", F.col("rd").cast("timestamp")), [("a", "ra"), ("b", "rb")], "d", "rd", {"v": "v"}, within=dt.timedelta(hours=48))
    assert rows_of(stamps, "a", "b", "v") == rows_of(out, "a", "b", "v")
    assert asof_join(left.limit(0), right, [("a", "ra")], "d", "rd", {"v": "v"}).count() == 0
    assert rows_of(asof_join(left, right.limit(0), [("a", "ra")], "d", "rd", {"v": "v"}), "v") == [(None,)] * 3
    for bad in ({"direction": "nearest"}, {"values": {"a": "v"}}, {"values": {}}, {"on": []}):
        with pytest.raises(ValueError):
            asof_join(**{"left": left, "right": right, "on": [("a", "ra")], "left_time": "d", "right_time": "rd", "values": {"v": "v"}, **bad})
    with pytest.raises(TypeError):
        asof_join(left, right, [("a", "ra")], "b", "rd", {"v": "v"})


def test_a_hot_key_is_cut_and_no_range_join_is_planned(spark):
    """A third of all rows under one key: many segments, of even size, and one shuffle of the rows."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), (F.col("id") * 7 % 5000).alias("t"), F.col("id"))
    right = rows.where("id % 2 = 0").select("k", "t", F.col("id").alias("v"))
    out = asof_join(rows, right, [("k", "k")], "t", "t", {"m": "v"}, rows_per_segment=200, cuts=31)
    plan = _plan(out)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "hashpartitioning(k" in plan and "seg" in plan
    whole = asof_join(rows, right, [("k", "k")], "t", "t", {"m": "v"})
    assert out.exceptAll(whole).count() == 0 and whole.exceptAll(out).count() == 0
    from daybook.operators.temporal import _hot_cuts

    points = rows.select(F.struct("k").alias("k"), F.col("t").cast("bigint").alias("t"))
    cuts = _hot_cuts(points, 200, 31).collect()
    assert [r["k"]["k"] for r in cuts] == ["hot"] and len(cuts[0]["cuts"]) > 25
    hot = points.where("k.k = 'hot'").select(F.size(F.filter(F.lit(cuts[0]["cuts"]), lambda c: c < F.col("t"))).alias("seg")).groupBy("seg").count()
    assert hot.agg(F.max("count")).first()[0] < 3 * 2000 / 32


def test_equal_instants_of_the_right_side_move_as_one_row(spark):
    many = spark.range(3000).select(F.lit("k").alias("k"), F.lit(5).alias("t"), F.col("id").alias("v"))
    left = spark.createDataFrame([("k", 5), ("k", 4)], "k string, t int")
    assert rows_of(asof_join(left, many, [("k", "k")], "t", "t", {"m": "v"}, rows_per_segment=10), "t", "m") == [(4, None), (5, 2999)]


# ---------------------------------------------------------------- spans


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([None, "a", "a", "b"]), st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.integers(-5, 400))), max_size=14),
    st.lists(st.tuples(st.sampled_from([None, "a", "a", "b"]), st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.integers(-5, 9))), max_size=14),
    st.sampled_from([1, 4, 1000]),
)
def test_interval_join_equals_all_pairs(spark, left, right, width):
    spans = lambda rows: [(i, k, a, None if None in (a, n) else a + n) for i, (k, a, n) in enumerate(rows)]
    left, right = spans(left), spans(right)
    schema = "id int, k string, a bigint, b bigint"
    ldf, rdf = spark.createDataFrame(left, schema).repartition(2), spark.createDataFrame(right, schema)
    out = interval_join(ldf, rdf, [("k", "k")], ("a", "b"), ("a", "b"), width)
    want = [
        (x[0], y[0]) for x, y in itertools.product(left, right)
        if None not in (*x, *y) and x[1] == y[1] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    ]
    assert sorted((r["l"]["id"], r["r"]["id"]) for r in out.collect()) == sorted(want)


def test_a_long_span_is_not_cut_into_short_buckets(spark):
    """One span a million widths long beside short ones: rows of the join stay few, no nested loop."""
    short = spark.range(2000).select(F.lit("k").alias("k"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    long = spark.createDataFrame([("k", -10**6, 10**6)], "k string, a bigint, b bigint")
    out = interval_join(short.unionByName(long), short, [("k", "k")], ("a", "b"), ("a", "b"), 1)
    assert "NestedLoopJoin" not in _plan(out) and "CartesianProduct" not in _plan(out)
    assert out.count() == 2000 + 2000 + 2 * 1999
    from daybook.operators.temporal import _bucketed, _levelled

    cut = _bucketed(_levelled(long, ["k"], ("a", "b"), 1.0, "l"), [0], 1.0)
    assert cut.count() <= 2
    with pytest.raises(ValueError):
        interval_join(short, short, [("k", "k")], ("a", "b"), ("a", "b"), 0)


# ---------------------------------------------------------------- merged partitions, incremental gold

SPEC = SeriesSpec(k="k", d="d", v="v", order_cols=("version",))
SCHEMA = "k string, d string, v double, version int"


def _versions(seed: int, n: int = 160):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        day = r.choice([None, "", "bad", *[f"2024-{m:02d}-{x:02d}" for m in range(1, 6) for x in (1, 2, 15, 28)]])
        rows.append((r.choice(["a", "b", "c", None]), day, r.choice([None, float("nan"), 0.0, 1.0, 2.0, 2.0, -3.5]), i))
    return rows


def _expected(spark, rows):
    return silver.latest_per_key(spark.createDataFrame(rows, SCHEMA), SPEC.business_key, SPEC.order_cols).select(*SPEC.series_cols)


def _same(a, b):
    show = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    assert show(a) == show(b)


@pytest.mark.parametrize("seed", [1, 2])
def test_gold_from_batches_in_any_order_equals_a_rebuild(spark, tmp_dir, seed):
    rows = _versions(seed)
    late = rows[:]
    random.Random(seed + 10).shuffle(late)
    batches = [late[:70], late[70:75], [], late[75:150], late[150:], late[:9]]  # late, tiny, empty and repeated ones
    for b in batches:
        folded = incremental_gold.apply_batch(spark.createDataFrame(b, SCHEMA), f"{tmp_dir}/silver", f"{tmp_dir}/state", SPEC)
    series = _expected(spark, rows)
    stored = partitions.read_partitioned(spark, f"{tmp_dir}/silver", spark.createDataFrame([], SCHEMA + ", segment string").schema)
    _same(stored.select(*SPEC.series_cols), series)
    _same(incremental_gold.extremes(folded, SPEC), gold.historical_extremes(series, SPEC, stamp=False))
    _same(incremental_gold.movements(folded, SPEC), gold.extreme_daily_movements(gold.daily_changes(series, SPEC, stamp=False), SPEC, stamp=False))


def _files(spark, path):
    fs, p = sinks._fs(spark, path)
    found = fs.listFiles(p, True)
    out = {}
    while found.hasNext():
        f = found.next()
        out[f.getPath().toString()] = f.getModificationTime()
    return {k: v for k, v in out.items() if k.endswith(".parquet")}


def test_only_touched_partitions_are_read_and_rewritten(spark, tmp_dir):
    first = [("a", f"2024-0{m}-01", float(m), 1) for m in range(1, 6)]
    incremental_gold.apply_batch(spark.createDataFrame(first, SCHEMA), f"{tmp_dir}/silver", f"{tmp_dir}/state", SPEC)
    before = _files(spark, f"{tmp_dir}/silver")
    late = spark.createDataFrame([("a", "2024-02-01", 9.0, 2), ("b", "2024-02-03", 1.0, 1)], SCHEMA)
    folded = incremental_gold.apply_batch(late, f"{tmp_dir}/silver", f"{tmp_dir}/state", SPEC)
    after = _files(spark, f"{tmp_dir}/silver")
    kept = {k for k in before if "2024-02" not in k}
    assert len(kept) == 4 and kept <= set(after) and all(before[k] == after[k] for k in kept)
    assert {k for k in after if k not in before and "segment=s2024-02" not in k} == set()
    # the change after the corrected day, across the border of its segment, is made anew
    fall = incremental_gold.movements(folded, SPEC).where("k = 'a'").first()
    assert (fall["date_biggest_depreciation"], fall["biggest_daily_fall_absolute"]) == ("2024-03-01", -6.0)
    schema = spark.createDataFrame([], SCHEMA + ", segment string").schema
    plan = _plan(partitions.read_partitioned(spark, f"{tmp_dir}/silver", schema).where(partitions._in("segment", ["s2024-02"])))
    assert re.search(r"PartitionFilters: \[[^\]]*segment", plan)


class _Ended(BaseException):
    """The process ends here: no handler of the library runs."""


@pytest.mark.parametrize("after", range(6))
def test_a_merge_that_ends_anywhere_is_completed_or_undone(spark, tmp_dir, monkeypatch, after):
    path = f"{tmp_dir}/t"
    schema = "k string, d string, v double, version int, segment string"
    rows = lambda v, n: spark.createDataFrame([("a", f"2024-0{m}-01", v, n, f"s{m}") for m in (1, 2)], schema)
    partitions.merge_rows(rows(1.0, 1), path, ["k", "d"], ["version"], "segment")
    calls, real = [], partitions._move

    def move(*a):
        calls.append(a)
        if len(calls) > after:
            raise _Ended
        real(*a)

    monkeypatch.setattr(partitions, "_move", move)
    if after < 5:  # the decision, then two moves for each of two partitions
        with pytest.raises(_Ended):
            partitions.merge_rows(rows(2.0, 2), path, ["k", "d"], ["version"], "segment")
    else:
        partitions.merge_rows(rows(2.0, 2), path, ["k", "d"], ["version"], "segment")
    monkeypatch.setattr(partitions, "_move", real)
    partitions.recover(spark, path)
    got = rows_of(partitions.read_partitioned(spark, path, rows(0.0, 0).schema), "d", "v")
    assert got == [("2024-01-01", 1.0 if after == 0 else 2.0), ("2024-02-01", 1.0 if after == 0 else 2.0)]
    assert not partitions._commits(spark, path)
    # an older version arrives late: nothing changes
    partitions.merge_rows(rows(7.0, 0), path, ["k", "d"], ["version"], "segment")
    assert rows_of(partitions.read_partitioned(spark, path, rows(0.0, 0).schema), "d", "v") == got
