"""Hand-made edge rows: one test per pinned semantic point."""

from __future__ import annotations

import math
from functools import partial

import pytest
from pyspark.sql import functions as F

from daybook.operators import gold, marts, quality, silver
from daybook.sources import incremental, payload
from daybook.spec import SeriesSpec, Thresholds
from tests.helpers import SPEC, rows_of, series
from tests.literal_forms import extremes_by_rank


def test_tie_on_extreme_picks_earliest_date(spark):
    s = series(spark, [("a", "2024-01-01", 2.0), ("a", "2024-01-02", 2.0)])
    for form in (partial(gold.historical_extremes, stamp=False), extremes_by_rank):
        r = form(s, SPEC).first()
        assert r["date_lowest_rate"] == "2024-01-01"
        assert r["date_highest_rate"] == "2024-01-01"
    assert marts.highest_rates(s, SPEC).first()["Date of Highest Rate"] == "2024-01-01"
    assert marts.lowest_rates(s, SPEC).first()["Date of Lowest Rate"] == "2024-01-01"


def test_nan_is_the_highest_value(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", float("nan"))])
    for form in (partial(gold.historical_extremes, stamp=False), extremes_by_rank):
        r = form(s, SPEC).first()
        assert math.isnan(r["highest_rate"]) and r["date_highest_rate"] == "2024-01-02"
        assert r["lowest_rate"] == 1.0 and r["date_lowest_rate"] == "2024-01-01"


def test_null_value_fails_the_silver_gate(spark, tmp_dir):
    b = spark.createDataFrame(
        [("a", "2024-01-01", None, 1), ("a", "2024-01-02", 1.0, 1)], "k string, d string, v double, ts int"
    )
    with pytest.raises(quality.QualityGateError):
        silver.build_silver(b, SPEC, tmp_dir)
    # nothing published, and the rejected staging directory is gone
    parent, name = tmp_dir.rsplit("/", 1)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(parent).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = [st.getPath().getName() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(parent))]
    assert not [x for x in left if x.startswith(name)]


def test_null_value_sorts_first_ascending_last_descending(spark):
    s = series(spark, [("a", "2024-01-01", None), ("a", "2024-01-02", 1.0)])
    agg = gold.historical_extremes(s, SPEC, stamp=False).first()
    win = extremes_by_rank(s, SPEC).first()
    assert agg["lowest_rate"] is None and agg["date_lowest_rate"] == "2024-01-01"
    assert agg["highest_rate"] == 1.0
    assert tuple(agg) == tuple(win)


def test_zero_previous_gives_null_percentage(spark):
    s = series(spark, [("a", "2024-01-01", 0.0), ("a", "2024-01-02", 1.0)])
    r = gold.daily_changes(s, SPEC, stamp=False).where("d = '2024-01-02'").first()
    assert r["daily_change_absolute"] == 1.0
    assert r["daily_change_percentage"] is None
    assert r["movement_direction"] == "Appreciation"
    ext = gold.historical_extremes(s, SPEC, stamp=False).first()
    assert ext["range_percentage"] is None  # lowest is 0


def test_invalid_dates_are_counted(spark):
    bad = ["2024-13-40", "2024-1-2", "2024-02-30", " 2024-01-02", None]
    s = series(spark, [("a", d, 1.0) for d in bad] + [("a", "2024-01-02", 1.0), ("a", "2024-03-01", 2.0)])
    r = quality.date_validation(s, "d").first()
    assert r["invalid_dates"] == 5
    assert (r["min_date"], r["max_date"]) == ("2024-01-02", "2024-03-01")


def test_integer_json_value_reads_as_double(spark):
    texts = spark.createDataFrame(
        [('{"code":"USD","currency":"dollar","table":"A","rates":[{"no":"1","effectiveDate":"2024-01-02","mid":4}]}',)],
        "value string",
    )
    r = payload.flatten_payload(payload.parse_payloads(texts)).first()
    assert r["mid"] == 4.0 and isinstance(r["mid"], float)
    flat = spark.createDataFrame(
        [('{"currency_code":"USD","currency_name":"d","table":"A","no":"1","effectiveDate":"2024-01-02","mid":4}',)],
        "value string",
    )
    assert payload.parse_declared(flat).first()["mid"] == 4.0


def test_payload_without_rates_contributes_nothing(spark):
    texts = spark.createDataFrame(
        [
            ('{"code":"USD"}',),
            ('{"code":"EUR","currency":"euro","table":"A","rates":[]}',),
            ('{"code":"GBP","currency":"pound","table":"A","rates":[{"no":"n1","effectiveDate":"2024-01-02","mid":5.1},'
             '{"no":"n2","effectiveDate":"2024-01-03","mid":5.2}]}',),
        ],
        "value string",
    )
    out = payload.flatten_payload(payload.parse_payloads(texts))
    assert out.columns == ["currency_code", "currency_name", "table", "no", "effectiveDate", "mid"]
    assert rows_of(out, "currency_code", "no", "mid") == [("GBP", "n1", 5.1), ("GBP", "n2", 5.2)]


def test_declared_read_quarantines_rows_not_batches(spark, tmp_dir):
    lines = [
        '{"currency_code":"USD","currency_name":"d","table":"A","no":"1","effectiveDate":"2024-01-02","mid":4.1}',
        '{"currency_code":"USD","currency_name":"d","table":"A","no":"2","effectiveDate":"2024-01-03"}',
        '{"currency_code":"USD","currency_name":"d","table":"A","no":"3","effectiveDate":"2024-01-04","mid":"abc"}',
        "not json at all",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_dir)
    parsed = payload.read_declared(spark, tmp_dir)
    accepted, quarantined = payload.declared_split(parsed)
    assert rows_of(accepted, "no") == [("1",)]
    reasons = {r["no"]: r["quarantine_reason"] for r in quarantined.collect()}
    assert reasons == {"2": "null:mid", "3": "malformed", None: "malformed"}


def test_same_batch_duplicates_resolve_deterministically(spark):
    b = spark.createDataFrame(
        [("a", "2024-01-01", 1.0, 5), ("a", "2024-01-01", 3.0, 5), ("a", "2024-01-01", 2.0, 4)],
        "k string, d string, v double, ts int",
    )
    picks = {
        tuple(silver.latest_per_key(b.repartition(n), ["k", "d"], ["ts"]).first()) for n in (1, 3, 7)
    }
    assert picks == {("a", "2024-01-01", 3.0, 5)}


def test_newest_version_wins(spark):
    b = spark.createDataFrame(
        [("a", "2024-01-01", 1.0, 1), ("a", "2024-01-01", 9.0, 2), ("b", "2024-01-01", 7.0, None),
         ("b", "2024-01-01", 8.0, 0)],
        "k string, d string, v double, ts int",
    )
    for m in ("aggregate", "window"):
        got = rows_of(silver.latest_per_key(b, ["k", "d"], ["ts"], method=m), "k", "v")
        assert got == [("a", 9.0), ("b", 8.0)]  # NULL order value is the oldest


def test_single_row_key(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0),
                       ("b", "2024-01-03", 1.5)])
    ch = gold.daily_changes(s, SPEC, stamp=False).where("k = 'a'").first()
    assert ch["previous_rate"] is None and ch["movement_direction"] == "No Change"
    d3 = gold.extreme_daily_movements(gold.daily_changes(s, SPEC, stamp=False), SPEC, stamp=False)
    assert rows_of(d3, "k") == [("b",)]
    assert rows_of(marts.biggest_appreciation(s, SPEC), "Currency") == [("b",)]


def test_only_falls_and_flat_keys(spark):
    s = series(
        spark,
        [("f", "2024-01-01", 3.0), ("f", "2024-01-02", 2.0), ("f", "2024-01-03", 1.0),
         ("z", "2024-01-01", 1.0), ("z", "2024-01-02", 1.0)],
    )
    ch = gold.daily_changes(s, SPEC, stamp=False)
    assert gold.extreme_daily_movements(ch, SPEC, stamp=False).count() == 0
    up = {r["Currency"]: r for r in marts.biggest_appreciation(s, SPEC).collect()}
    assert up["f"]["Change (Appreciation)"] == -1.0 and up["f"]["Date"] == "2024-01-02"
    assert up["z"]["Change (Appreciation)"] == 0.0
    assert rows_of(ch.where("k = 'z' AND previous_rate IS NOT NULL"), "movement_direction") == [("No Change",)]


def test_calendar_gap_uses_previous_available_day(spark):
    s = series(spark, [("a", "2024-01-05", 1.0), ("a", "2024-01-08", 1.5)])
    r = gold.daily_changes(s, SPEC, stamp=False).where("d = '2024-01-08'").first()
    assert r["previous_rate"] == 1.0 and r["daily_change_percentage"] == 50.0


def test_empty_table(spark):
    s = series(spark, [])
    assert rows_of(quality.null_profile(s, ["k", "d", "v"]), "null_count", "null_percentage") == [(0, 0.0)] * 3
    assert tuple(quality.value_stats(s, "v").first()) == (None, None, None)
    assert incremental.high_watermark(s, "d").first()["watermark"] is None
    assert tuple(quality.duplicate_keys(s, ["k", "d"]).first()) == (0, 0.0)
    assert tuple(quality.invalid_values(s, "v").first()) == (0, 0.0)
    assert tuple(silver.dedup_stats(s, ["k", "d"]).first()) == (0, 0, 0, 0.0)


def test_up_to_date_batch_is_empty(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", 1.0)])
    assert incremental.incremental_batch(s, "d", "2024-01-02", target=s).count() == 0
    assert incremental.incremental_batch(s, "d", "2024-01-03", target=s.where("d = '2024-01-01'")).count() == 1


def test_full_mode_goes_back_whole_years(spark):
    assert incremental.batch_bounds("2024-02-29", None, 5) == ("2019-02-28", "2024-02-29", True)
    assert incremental.batch_bounds("2024-05-01", "2024-04-30", 5) == ("2024-04-30", "2024-05-01", False)


def test_load_windows_cover_the_last_day():
    w = incremental.load_windows("1995-01-01", "2001-12-31")
    assert w == [
        ("1995-01-01", "1996-01-01"), ("1996-01-02", "1997-01-02"), ("1997-01-03", "1998-01-03"),
        ("1998-01-04", "1999-01-04"), ("1999-01-05", "2000-01-05"), ("2000-01-06", "2001-01-06"),
        ("2001-01-07", "2001-12-31"),
    ]
    # a window ending one day before the end still leaves the end covered
    w2 = incremental.load_windows("2020-01-01", "2021-01-02")
    assert w2[-1] == ("2021-01-02", "2021-01-02")


def test_coverage_reports_zero_windows(spark):
    s = series(spark, [("USD", "2020-01-05", 1.0), ("USD", "2021-03-01", 1.0)])
    keys = quality.expected_keys_frame(spark, "k", ["USD", "EUR"])
    cov = incremental.load_window_coverage(s, "k", "d", keys, "2020-01-01", "2021-12-31")
    got = rows_of(cov, "k", "window_start", "n")
    assert got == [("EUR", "2020-01-01", 0), ("EUR", "2021-01-02", 0), ("USD", "2020-01-01", 1),
                   ("USD", "2021-01-02", 1)]


def test_missing_key_is_a_warning(spark):
    s = series(spark, [("USD", "2024-01-02", 4.0)])
    spec = SeriesSpec(k="k", d="d", v="v", order_cols=("ts",), expected_keys=("USD", "EUR"),
                      thresholds=Thresholds(min_expected_records=1))
    rep = quality.quality_report(s, spec)
    miss = rep.where("check = 'missing_key'").collect()
    assert [(r["subject"], r["severity"]) for r in miss] == [("EUR", "warning")]
    assert quality.is_valid(rep)


def test_strict_gate(spark):
    s = series(spark, [("USD", "2024-01-02", -1.0)])
    spec = SeriesSpec(k="k", d="d", v="v", order_cols=("ts",), expected_keys=("USD",))
    rep = quality.quality_report(s, spec)
    assert quality.enforce(rep, strict=False) is False
    with pytest.raises(quality.QualityGateError):
        quality.enforce(rep, strict=True)


def test_report_severities(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-01", 1.0), (None, "2024-01-02", 1.0),
                       ("a", "bad", float("nan"))])
    spec = SeriesSpec(k="k", d="d", v="v", order_cols=("ts",), expected_keys=())
    rep = {(r["check"], r["subject"]): r for r in quality.quality_report(s, spec).collect()}
    assert rep[("null_check", "k")]["severity"] == "error" and rep[("null_check", "k")]["count"] == 1
    assert rep[("duplicate_check", "k,d")]["count"] == 1 and rep[("duplicate_check", "k,d")]["severity"] == "warning"
    assert rep[("value_check", "v")]["count"] == 1
    assert rep[("date_check", "d")]["count"] == 1
    assert rep[("record_count", "a")]["severity"] == "warning"


def test_direction_of_d3_versus_e1(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", 3.0), ("a", "2024-01-03", 2.5),
                       ("a", "2024-01-04", 2.0)])
    d3 = gold.extreme_daily_movements(gold.daily_changes(s, SPEC, stamp=False), SPEC, stamp=False).first()
    assert d3["biggest_daily_rise_absolute"] == 2.0 and d3["date_biggest_appreciation"] == "2024-01-02"
    assert d3["biggest_daily_fall_absolute"] == -0.5 and d3["date_biggest_depreciation"] == "2024-01-03"
    assert d3["biggest_daily_rise_percentage"] == 200.0


def test_stamps_are_constant_per_query(spark):
    s = series(spark, [("a", f"2024-01-{i:02d}", float(i)) for i in range(1, 20)]).repartition(4)
    st = payload.stamp_ingestion(s)
    assert st.select(F.countDistinct("ingestion_timestamp")).first()[0] == 1
    assert silver.stamp_processing(s).select(F.countDistinct("processing_timestamp")).first()[0] == 1


def test_small_values_are_not_rounded(spark):
    s = series(spark, [("JPY", "2024-01-02", 0.025611), ("JPY", "2024-01-03", 1e-08)])
    line = dict(rows_of(marts.rate_line_series(s, SPEC), "d", "avg(v)"))
    assert line == {"2024-01-02": 0.025611, "2024-01-03": 1e-08}
    assert quality.value_stats(s.where("d = '2024-01-03'"), "v").first()["mean_value"] == 1e-08


def test_coverage_of_an_empty_range_is_empty(spark):
    keys = spark.createDataFrame([("a",)], "k string")
    out = incremental.load_window_coverage(series(spark, [("a", "2024-01-02", 1.0)]), "k", "d", keys, "2024-02-01", "2024-01-01")
    assert out.columns == ["k", "window_start", "window_end", "n"] and out.count() == 0


def test_report_holds_statistics_and_the_date_range(spark):
    s = series(spark, [("a", "2024-01-02", 1.0), ("a", "2024-01-03", 3.0), ("b", "2024-02-30", float("nan")), ("b", None, None)])
    r = {(x["check"], x["subject"]): x for x in quality.quality_report(s, SPEC).collect()}
    assert [r["value_stats", n]["value"] for n in ("min", "max", "mean")] == [1.0, 3.0, 2.0]
    assert r["value_stats", "mean"]["count"] == 2 and r["date_range", "2024-01-02..2024-01-03"]["count"] == 2
