"""Sinks (F1-F5), the layered pipeline end to end, and the streaming ingest."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from daybook.operators import quality
from daybook.plans import pipeline
from daybook.sinks import tables as sinks
from daybook.spec import SeriesSpec, Thresholds
from daybook.streaming import start_bronze_ingest
from tests.helpers import rows_of, series


def test_append_with_added_column(spark, tmp_dir):
    s = series(spark, [("a", "2024-01-01", 1.0)])
    sinks.append_table(s, tmp_dir)
    sinks.append_table(series(spark, [("a", "2024-01-02", 2.0)]).withColumn("x", F.lit(7)), tmp_dir)
    got = rows_of(sinks.read_table(spark, tmp_dir, merge=True), "d", "x")
    assert got == [("2024-01-01", None), ("2024-01-02", 7)]


def test_overwrite_replaces_schema_even_when_reading_itself(spark, tmp_dir):
    sinks.overwrite_table(series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", 2.0)]), tmp_dir)
    cur = sinks.read_table(spark, tmp_dir)
    out = sinks.overwrite_table(cur.where("v > 1").select("k", (F.col("v") * 10).alias("w")), tmp_dir)
    assert out.columns == ["k", "w"] and rows_of(out) == [("a", 20.0)]


def test_ctas_and_view(spark, tmp_dir):
    name = "t_" + tmp_dir.rsplit("-", 1)[-1]
    sinks.create_or_replace_table_as(series(spark, [("a", "2024-01-01", 1.0)]), name, f"{tmp_dir}/a")
    t = sinks.create_or_replace_table_as(spark.table(name).withColumn("z", F.lit(1)), name, f"{tmp_dir}/b")
    assert t.columns == ["k", "d", "v", "z"] and t.count() == 1
    v = sinks.create_or_replace_view(spark.table(name).where("v > 0"), "vw_test")
    assert v.count() == 1


def test_verify_write_counts_written_rows(spark, tmp_dir):
    sinks.append_table(series(spark, [("a", "2024-01-01", 1.0)]), tmp_dir)
    r = sinks.verify_write(series(spark, [("a", "2024-01-02", 1.0), ("b", "2024-01-02", 1.0)]), tmp_dir).first()
    assert (r["written"], r["table_total"]) == (2, 3)


def _landing(spark, path, payloads):
    spark.createDataFrame([(json.dumps(p),) for p in payloads], "value string").coalesce(1).write.mode(
        "append"
    ).text(path)


def _payload(code, dates, start=1.0):
    return {
        "code": code,
        "currency": code.lower(),
        "table": "A",
        "rates": [{"no": f"{code}{i}", "effectiveDate": d, "mid": start + i} for i, d in enumerate(dates)],
    }


RATE = SeriesSpec(thresholds=Thresholds(min_expected_records=1))


def test_layers_end_to_end(spark, tmp_dir):
    landing, bronze, silver_p, gold_dir = (f"{tmp_dir}/{x}" for x in ("landing", "bronze", "silver", "gold"))
    _landing(spark, landing, [_payload("USD", ["2024-01-02", "2024-01-03"]), _payload("EUR", ["2024-01-02"])])
    first = pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE)
    assert first.mode == "full" and first.written.first()["written"] == 3
    # GBP and JPY are expected but absent -> warnings only
    warn = first.report.where("severity = 'warning' AND check = 'missing_key'").count()
    assert warn == 2 and first.valid
    assert pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE).mode == "up_to_date"
    # a later landing with a corrected value for an old day and a new day
    _landing(spark, landing, [_payload("USD", ["2024-01-03", "2024-01-04"], start=5.0)])
    second = pipeline.run_bronze(spark, landing, bronze, "2024-01-04", RATE)
    assert second.mode == "incremental" and second.written.first()["written"] == 1  # only 01-04 is new
    s = pipeline.run_silver(spark, bronze, silver_p, RATE)
    assert s.count() == 4
    g = pipeline.run_gold(spark, silver_p, gold_dir, RATE)
    counts = dict(rows_of(g["record_counts"]))
    assert counts == {"Historical Extremes": 2, "Daily Changes": 4, "Extreme Daily Movements": 0}
    dash = pipeline.dashboard(spark, silver_p, RATE)
    assert rows_of(dash["row_count"]) == [("EUR", 1), ("USD", 3)]


def test_streaming_ingest_loads_each_file_once(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _landing(spark, landing, [_payload("USD", ["2024-01-02", "2024-01-03"])])
    reports = []
    ckpt = f"{tmp_dir}/ckpt"
    q = start_bronze_ingest(spark, landing, bronze, RATE, checkpoint=ckpt,
                            on_report=lambda e, r: reports.append(r.count()))
    q.awaitTermination(120)
    _landing(spark, landing, [_payload("EUR", ["2024-01-02"])])
    q = start_bronze_ingest(spark, landing, bronze, RATE, checkpoint=ckpt)
    q.awaitTermination(120)
    out = spark.read.parquet(bronze)
    assert out.count() == 3
    assert rows_of(out.groupBy("currency_code").count()) == [("EUR", 1), ("USD", 2)]
    assert reports and reports[0] > 0


def test_streaming_strict_gate_stops_bad_batches(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    bad = _payload("USD", ["2024-01-02"])
    bad["rates"][0]["mid"] = -1.0
    _landing(spark, landing, [bad])
    strict = SeriesSpec(thresholds=Thresholds(strict_mode=True, min_expected_records=1))
    q = start_bronze_ingest(spark, landing, bronze, strict, checkpoint=f"{tmp_dir}/ckpt")
    with pytest.raises(Exception):
        q.awaitTermination(120)
    assert not sinks.path_exists(spark, bronze)


def test_silver_gate_reports(spark):
    s = series(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-01", 2.0)])
    spec = SeriesSpec(k="k", d="d", v="v", order_cols=("ts",))
    with pytest.raises(quality.QualityGateError):
        quality.enforce_verdict(quality.silver_verdict(s, spec))


def test_bronze_strict_gate_leaves_target_untouched(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    bad = _payload("USD", ["2024-01-02", "2024-01-03"])
    bad["rates"][1]["effectiveDate"] = "2024-02-30"  # inside the load range, not a date
    _landing(spark, landing, [bad])
    strict = SeriesSpec(thresholds=Thresholds(strict_mode=True, min_expected_records=1))
    with pytest.raises(quality.QualityGateError):
        pipeline.run_bronze(spark, landing, bronze, "2024-12-31", strict)
    assert not sinks.path_exists(spark, bronze)
    # not strict: the batch is written and the report says why it is invalid
    lax = pipeline.run_bronze(spark, landing, bronze, "2024-12-31", RATE)
    assert lax.valid is False and lax.written.first()["written"] == 2  # whole batch, as flagged


def test_jobs_run_the_layers(spark, tmp_dir):
    from daybook.plans import jobs

    landing = f"{tmp_dir}/landing"
    _landing(spark, landing, [_payload("USD", ["2024-01-02", "2024-01-03", "2024-01-04"]),
                              _payload("EUR", ["2024-01-02", "2024-01-03"], start=4.0)])
    common = ["--expected", "USD,EUR", "--min-records", "1"]
    b = jobs.run(common + ["bronze", "--landing", landing, "--bronze", f"{tmp_dir}/b", "--as-of", "2024-01-04"], spark)
    assert b["mode"] == "full" and b["written"] == 5 and b["errors"] == 0 and b["warnings"] == 0
    assert jobs.run(common + ["silver", "--bronze", f"{tmp_dir}/b", "--silver", f"{tmp_dir}/s"], spark) == {
        "silver_rows": 5
    }
    g = jobs.run(common + ["gold", "--silver", f"{tmp_dir}/s", "--gold", f"{tmp_dir}/g"], spark)
    assert g == {"Historical Extremes": 2, "Daily Changes": 5, "Extreme Daily Movements": 0}
    d = jobs.run(common + ["dashboard", "--silver", f"{tmp_dir}/s", "--out", f"{tmp_dir}/d"], spark)
    assert "biggest_appreciation" in d["datasets"]
    cols = spark.read.parquet(f"{tmp_dir}/d/biggest_appreciation").columns
    assert cols == ["Currency", "Date", "Previous_Rate", "New_Rate", "Change__Appreciation"]


def test_streaming_backlog_runs_in_bounded_batches(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    for i in range(3):  # three landed files
        _landing(spark, landing, [_payload("USD", [f"2024-01-0{i + 1}"], start=float(i + 1))])
    epochs = []
    q = start_bronze_ingest(spark, landing, bronze, RATE, checkpoint=f"{tmp_dir}/ckpt",
                            on_report=lambda e, r: epochs.append(e), max_files_per_trigger=1)
    q.awaitTermination(120)
    assert len(epochs) == 3
    assert spark.read.parquet(bronze).count() == 3


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def _four_records():
    good, null_date, bad_date = _payload("USD", ["2024-01-02"]), _payload("EUR", ["x"]), _payload("GBP", ["2024-13-40"])
    null_date["rates"][0]["effectiveDate"] = None
    return [json.dumps(good), json.dumps(null_date), json.dumps(bad_date), '{"code": "JPY", "rates": [{"no"']


def test_bronze_loses_no_record(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _lines(spark, landing, _four_records())
    strict = SeriesSpec(thresholds=Thresholds(strict_mode=True, min_expected_records=1))
    with pytest.raises(quality.QualityGateError):
        pipeline.run_bronze(spark, landing, bronze, "2024-05-01", strict)
    assert not sinks.path_exists(spark, bronze)
    r = pipeline.run_bronze(spark, landing, bronze, "2024-05-01", RATE)
    assert r.valid is False and r.written.first()["written"] + r.quarantined == 4
    kept = sinks.read_table(spark, pipeline.quarantine_path(bronze))
    reasons = rows_of(kept, "quarantine_reason")
    assert reasons == [("malformed",), ("null:effectiveDate",)]
    assert kept.where("source_file is null or (quarantine_reason = 'malformed' and _corrupt_record is null)").count() == 0
    # nothing new has landed: no batch, no second copy of the rejects
    again = pipeline.run_bronze(spark, landing, bronze, "2024-06-01", RATE)
    assert again.mode == "empty" and again.written is None
    assert sinks.read_table(spark, pipeline.quarantine_path(bronze)).count() == 2
    assert sinks.read_table(spark, bronze).count() == r.written.first()["written"]


def test_bronze_takes_later_dates_of_a_file_in_a_later_run(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _landing(spark, landing, [_payload("USD", ["2024-01-02", "2024-01-09"])])
    assert pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE).written.first()["written"] == 1
    later = pipeline.run_bronze(spark, landing, bronze, "2024-01-10", RATE)
    assert later.mode == "incremental" and later.written.first()["written"] == 1
    assert pipeline.run_bronze(spark, landing, bronze, "2024-02-10", RATE).mode == "empty"


def test_bronze_without_checks_and_on_an_empty_directory(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    fs, p = sinks._fs(spark, bronze)
    fs.mkdirs(p)  # a run that stopped early
    _landing(spark, landing, [_payload("USD", ["2024-01-02"])])
    r = pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE, run_quality_checks=False)
    assert r.mode == "full" and r.report is None and r.written.first()["written"] == 1


def test_an_invalid_stored_date_does_not_hide_later_loads(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _landing(spark, landing, [_payload("USD", ["2024-01-02", "2024-99-99"])])
    assert pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE).written.first()["written"] == 2
    _landing(spark, landing, [_payload("USD", ["2024-01-04"])])
    assert pipeline.run_bronze(spark, landing, bronze, "2024-01-04", RATE).written.first()["written"] == 1


def test_stream_restart_without_a_checkpoint_argument_keeps_both_batches(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _landing(spark, landing, [_payload("USD", ["2024-01-02"])])
    start_bronze_ingest(spark, landing, bronze, RATE).awaitTermination(120)
    fs, p = sinks._fs(spark, landing)
    fs.delete(p, True)
    _landing(spark, landing, [_payload("EUR", ["2024-01-02"])])
    start_bronze_ingest(spark, landing, bronze, RATE).awaitTermination(120)
    assert rows_of(spark.read.parquet(bronze), "currency_code") == [("EUR",), ("USD",)]


def _failing_rename(monkeypatch, after):
    calls = []
    real = sinks._move

    def move(fs, src, dst, what):
        calls.append(what)
        if len(calls) > after:
            raise OSError("injected")
        real(fs, src, dst, what)

    monkeypatch.setattr(sinks, "_move", move)


def test_append_that_fails_to_publish_leaves_the_table_whole(spark, tmp_dir, monkeypatch):
    sinks.append_table(series(spark, [("a", "2024-01-01", 1.0)]), tmp_dir)
    _failing_rename(monkeypatch, after=0)
    with pytest.raises(OSError):
        sinks.append_table(series(spark, [("b", "2024-01-01", 1.0), ("c", "2024-01-01", 1.0)]).repartition(2), tmp_dir)
    assert rows_of(sinks.read_table(spark, tmp_dir), "k") == [("a",)]


def test_replace_that_fails_to_publish_puts_the_old_table_back(spark, tmp_dir, monkeypatch):
    sinks.overwrite_table(series(spark, [("a", "2024-01-01", 1.0)]), tmp_dir)
    _failing_rename(monkeypatch, after=1)
    with pytest.raises(OSError):
        sinks.overwrite_table(series(spark, [("b", "2024-01-01", 1.0)]), tmp_dir)
    assert rows_of(sinks.read_table(spark, tmp_dir), "k") == [("a",)]


@pytest.mark.parametrize("located", [True, False])
def test_ctas_replaces_itself_and_survives_a_failed_write(spark, tmp_dir, located):
    name = "t_self_" + tmp_dir.rsplit("-", 1)[-1] + str(int(located))
    path = f"{tmp_dir}/ctas" if located else None
    try:
        sinks.create_or_replace_table_as(series(spark, [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0)]), name, path)
        t = sinks.create_or_replace_table_as(spark.table(name).where("v > 1").select("k"), name, path)
        assert t.columns == ["k"] and rows_of(t) == [("b",)]
        with pytest.raises(Exception):
            sinks.create_or_replace_table_as(spark.table(name).select(F.raise_error(F.lit("x")).alias("k")), name, path)
        assert rows_of(spark.table(name)) == [("b",)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_scratch_needs_a_shared_folder():
    class Unset:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError):
        sinks.shared_dir(Unset)


def test_bronze_counts_records_before_the_load_window(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    _landing(spark, landing, [_payload("USD", ["2015-01-02", "2024-01-02", "2024-01-09"])])
    first = pipeline.run_bronze(spark, landing, bronze, "2024-01-03", RATE)
    assert (first.outside_window, first.written.first()["written"]) == (1, 1)  # 2015 is older than the years back
    row = first.report.where("check = 'load_window'").first()
    assert row[2] == 1 and row["severity"] == "warning"
    # a file of old days in an incremental run; the first file's later day is taken, its old ones not counted again
    _landing(spark, f"{landing}/below", [_payload("EUR", ["2023-12-31", "2024-01-02", "2024-01-04"])])
    second = pipeline.run_bronze(spark, landing, bronze, "2024-01-10", RATE)
    assert (second.outside_window, second.written.first()["written"]) == (2, 2)
    assert pipeline.run_bronze(spark, landing, bronze, "2024-02-10", RATE).mode == "empty"


def test_stream_keeps_what_it_cannot_accept(spark, tmp_dir):
    """Malformed lines and NULL values end in quarantine, across a restart, with the report."""
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    null_mid = _payload("USD", ["2024-01-02", "2024-01-03"])
    null_mid["rates"][1]["mid"] = None
    _lines(spark, landing, [json.dumps(null_mid), '{"code": "EUR", "rates": [{"no": "E1", "effectiveDate": "2024-0'])
    reports = {}
    start_bronze_ingest(spark, landing, bronze, RATE, on_report=lambda e, r: reports.update({e: r.where("check = 'malformed_check'").first()[2]})).awaitTermination(120)
    _lines(spark, landing, ["not json at all", json.dumps(_payload("GBP", ["2024-01-02"]))])
    start_bronze_ingest(spark, landing, bronze, RATE).awaitTermination(120)
    assert rows_of(sinks.read_table(spark, bronze), "currency_code", "effectiveDate") == [("GBP", "2024-01-02"), ("USD", "2024-01-02")]
    kept = sinks.read_table(spark, sinks.quarantine_path(bronze))
    assert rows_of(kept, "quarantine_reason") == [("malformed",), ("malformed",), ("null:mid",)]
    assert kept.where("source_file is null or (quarantine_reason = 'malformed' and _corrupt_record is null)").count() == 0
    assert kept.where("_corrupt_record = 'not json at all'").count() == 1
    assert list(reports.values()) == [1]
    stored = sinks.read_table(spark, sinks.report_path(bronze)).where("check = 'malformed_check'")
    assert stored.count() == 2 and stored.where("severity = 'error'").count() == 2
    # nothing has landed: nothing is written twice
    start_bronze_ingest(spark, landing, bronze, RATE).awaitTermination(120)
    assert sinks.read_table(spark, bronze).count() == 2 and kept.count() == 3


def test_stream_can_set_a_bad_batch_aside(spark, tmp_dir):
    landing, bronze = f"{tmp_dir}/landing", f"{tmp_dir}/bronze"
    bad = _payload("USD", ["2024-01-02"])
    bad["rates"][0]["mid"] = -1.0
    _landing(spark, landing, [bad])
    strict = SeriesSpec(thresholds=Thresholds(strict_mode=True, min_expected_records=1))
    with pytest.raises(Exception):
        start_bronze_ingest(spark, landing, bronze, strict).awaitTermination(120)
    _landing(spark, landing, [_payload("EUR", ["2024-01-02"])])
    start_bronze_ingest(spark, landing, bronze, strict, on_gate="quarantine").awaitTermination(120)  # judges the first batch again
    assert rows_of(sinks.read_table(spark, bronze), "currency_code") == [("EUR",)]
    assert rows_of(sinks.read_table(spark, sinks.quarantine_path(bronze)), "currency_code", "quarantine_reason") == [("USD", "gate")]
    with pytest.raises(ValueError):
        start_bronze_ingest(spark, landing, bronze, strict, on_gate="ignore")


class _Ended(BaseException):
    """The process ends here: no handler of the library runs."""


def _ending(monkeypatch, name, after=0):
    calls, real = [], getattr(sinks, name)

    def step(*a):
        calls.append(a)
        if len(calls) > after:
            raise _Ended
        return real(*a)

    monkeypatch.setattr(sinks, name, step)


def test_an_interrupted_replace_is_read_and_put_back(spark, tmp_dir, monkeypatch):
    sinks.overwrite_table(series(spark, [("a", "2024-01-01", 1.0)]), tmp_dir)
    with monkeypatch.context() as m:
        _ending(m, "_move", after=1)  # between the two renames
        with pytest.raises(_Ended):
            sinks.overwrite_table(series(spark, [("b", "2024-01-01", 1.0)]), tmp_dir)
    assert not sinks.path_exists(spark, tmp_dir)
    assert rows_of(sinks.read_table(spark, tmp_dir), "k") == [("a",)]  # readable at once
    sinks.append_table(series(spark, [("c", "2024-01-01", 1.0)]), tmp_dir)  # a write puts it back first
    assert rows_of(sinks.read_table(spark, tmp_dir), "k") == [("a",), ("c",)]
    out = sinks.overwrite_table(series(spark, [("d", "2024-01-01", 1.0)]), tmp_dir)
    assert rows_of(out, "k") == [("d",)] and not sinks._set_aside(spark, tmp_dir)


def test_a_replace_that_ended_before_its_clean_up(spark, tmp_dir, monkeypatch):
    sinks.overwrite_table(series(spark, [("a", "2024-01-01", 1.0)]), tmp_dir)
    with monkeypatch.context() as m:
        _ending(m, "_move", after=1)
        with pytest.raises(_Ended):
            sinks.overwrite_table(series(spark, [("b", "2024-01-01", 1.0)]), tmp_dir)
    series(spark, [("new", "2024-01-01", 1.0)]).write.parquet(tmp_dir)  # as if the second rename had happened
    assert sinks.recover(spark, tmp_dir) is False and not sinks._set_aside(spark, tmp_dir)
    assert rows_of(sinks.read_table(spark, tmp_dir), "k") == [("new",)]


def test_an_interrupted_ctas_is_completed(spark, tmp_dir, monkeypatch):
    name, path = "t_end_" + tmp_dir.rsplit("-", 1)[-1], f"{tmp_dir}/ctas"
    try:
        sinks.create_or_replace_table_as(series(spark, [("a", "2024-01-01", 1.0)]), name, path)
        with monkeypatch.context() as m:
            _ending(m, "_create")  # other columns: dropped, not yet created
            with pytest.raises(_Ended):
                sinks.create_or_replace_table_as(series(spark, [("b", "2024-01-01", 2.0)]).select("k"), name, path)
        assert not spark.catalog.tableExists(name)
        assert rows_of(sinks.open_table(spark, name, path)) == [("b",)]
        with monkeypatch.context() as m:
            _ending(m, "_create")
            with pytest.raises(_Ended):
                sinks.create_or_replace_table_as(series(spark, [("c", "2024-01-01", 2.0)]).select("v"), name, path)
        t = sinks.create_or_replace_table_as(series(spark, [("d", "2024-01-01", 2.0)]).select("k"), name, path)  # completes it first
        assert rows_of(t) == [("d",)]
        # the same columns: one change of the location, the table is there at every moment
        dropped = []
        real = spark.sql
        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", lambda self, q, *a, **k: dropped.append(q) or real(q, *a, **k))
            t = sinks.create_or_replace_table_as(spark.table(name).select(F.upper("k").alias("k")), name, path)
        assert rows_of(t) == [("D",)] and not [q for q in dropped if q.startswith("DROP")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
