"""Command-line jobs: one per layer, for spark-submit on a cluster.

    python -m daybook.plans.jobs bronze --landing L --bronze B --as-of 2024-05-01 [--strict] [--skip-checks]
    python -m daybook.plans.jobs silver --bronze B --silver S
    python -m daybook.plans.jobs gold --silver S --gold G
    python -m daybook.plans.jobs dashboard --silver S --out O

The session is whatever the cluster gives (``getOrCreate``); only settings
that are unset are filled in. Column roles default to the rate-table layout
and can be changed with --key/--date/--value/--order.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from daybook.plans import pipeline
from daybook.plans.session import apply_defaults
from daybook.sinks.tables import overwrite_table
from daybook.spec import SeriesSpec, Thresholds


def _spec(a: argparse.Namespace) -> SeriesSpec:
    spec = SeriesSpec(k=a.key, d=a.date, v=a.value, order_cols=tuple(a.order.split(",")))
    if a.expected is not None:
        spec = replace(spec, expected_keys=tuple(x for x in a.expected.split(",") if x))
    th = Thresholds(
        min_expected_records=a.min_records, strict_mode=a.strict, max_null_percentage=a.max_null_pct,
        max_duplicate_percentage=a.max_dup_pct,
    )
    return replace(spec, thresholds=th)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="daybook")
    p.add_argument("--key", default="currency_code")
    p.add_argument("--date", default="effectiveDate")
    p.add_argument("--value", default="mid")
    p.add_argument("--order", default="ingestion_timestamp")
    p.add_argument("--expected", default=None, help="comma-separated expected keys")
    p.add_argument("--min-records", type=int, default=100)
    p.add_argument("--max-null-pct", type=float, default=0.0)
    p.add_argument("--max-dup-pct", type=float, default=0.0)
    p.add_argument("--strict", action="store_true")
    sub = p.add_subparsers(dest="step", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("--landing", required=True)
    b.add_argument("--bronze", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--skip-checks", action="store_true", help="load without the quality report")
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    g = sub.add_parser("gold")
    g.add_argument("--silver", required=True)
    g.add_argument("--gold", required=True)
    d = sub.add_parser("dashboard")
    d.add_argument("--silver", required=True)
    d.add_argument("--out", required=True)
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = apply_defaults(spark or SparkSession.builder.appName(f"daybook-{a.step}").getOrCreate())
    spec = _spec(a)
    if a.step == "bronze":
        r = pipeline.run_bronze(spark, a.landing, a.bronze, a.as_of, spec, run_quality_checks=not a.skip_checks)
        out = {"mode": r.mode, "valid": r.valid, "quarantined": r.quarantined}
        if r.written is not None:
            w = r.written.first()
            out.update(written=w["written"], table_total=w["table_total"])
        if r.report is not None:
            out["errors"] = r.report.where("severity = 'error'").count()
            out["warnings"] = r.report.where("severity = 'warning'").count()
        return out
    if a.step == "silver":
        s = pipeline.run_silver(spark, a.bronze, a.silver, spec)
        return {"silver_rows": s.count()}
    if a.step == "gold":
        g = pipeline.run_gold(spark, a.silver, a.gold, spec)
        return {r["table_name"]: r["record_count"] for r in g["record_counts"].collect()}
    dash = pipeline.dashboard(spark, a.silver, spec)
    base = a.out.rstrip("/")
    for name, df in dash.items():
        overwrite_table(_safe_names(df), f"{base}/{name}")
    return {"datasets": sorted(dash)}


def _safe_names(df):
    """Parquet column names without spaces or parentheses."""
    bad = " ,;{}()\n\t="
    return df.toDF(*["".join("_" if ch in bad else ch for ch in c).strip("_") for c in df.columns])


def main() -> None:
    print(json.dumps(run(sys.argv[1:])))


if __name__ == "__main__":
    main()
