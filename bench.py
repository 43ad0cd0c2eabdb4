"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through the no-op sink (every row is
produced, nothing is collected to the driver). Every query first runs
$BENCH_WARMUP times (the JVM compiles the hot paths during the first few
runs, so otherwise the queries timed first would carry it), then $BENCH_RUNS
rounds run every query once each, interleaved so that machine noise falls on
all queries alike; the median per query is reported. Window ("_window") and aggregate
forms of the same operator, and the per-key and the year-segmented ("_split")
previous-value lag, are timed side by side; the headline value sums the
default forms only. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from functools import partial

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.functions.previous import YEAR  # noqa: E402
from daybook.operators import gold, marts, quality, silver  # noqa: E402
from daybook.plans import bindings as B  # noqa: E402
from daybook.plans import registry as R  # noqa: E402
from daybook.plans.session import local_session  # noqa: E402
from tests.literal_forms import extremes_by_rank, moves_by_rank  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
WARMUP = int(os.environ.get("BENCH_WARMUP", "2"))
PARTS = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(CPUS * 2)))


def _supp(spark):
    return B.supp_bronze(spark, SF_DIR)


def _supp_series(spark):
    b, spec = _supp(spark)
    return B.series_of(b, spec), spec


def dedup(method):
    def q(spark):
        b, spec = _supp(spark)
        return silver.latest_per_key(b, spec.business_key, spec.order_cols, method=method)

    return q


def extremes(form):
    def q(spark):
        return form(*_supp_series(spark))

    return q


def changes(segment):
    def q(spark):
        s, spec = _supp_series(spark)
        return gold.daily_changes(s, spec, stamp=False, segment=segment)

    return q


def moves(form, segment=None):
    def q(spark):
        s, spec = _supp_series(spark)
        return form(gold.daily_changes(s, spec, stamp=False, segment=segment), spec)

    return q


def appreciation(method):
    def q(spark):
        b, spec = B.cust_bronze(spark, SF_DIR)
        return marts.biggest_appreciation(B.series_of(b, spec), spec, method=method)

    return q


def appreciation_split(spark):
    b, spec = B.cust_bronze(spark, SF_DIR)
    s = B.series_of(b, spec)
    change = F.col("_chg")
    return marts.with_previous(s, spec, segment=YEAR).where(change.isNotNull()).groupBy(spec.k).agg(
        F.min(F.struct(-change, F.col(spec.d), F.col("_prev"), F.col(spec.v)))
    )


def summary_tables(spark):
    return R.q_executive_summary_tables(spark, SF_DIR)


def summary_fused(spark):
    return R.q_executive_summary(spark, SF_DIR)


def report(spark):
    return R.q_quality_report(spark, SF_DIR)


def verdict(spark):
    s, spec = _supp_series(spark)
    return quality.silver_verdict(s, spec)


def coverage(spark):
    return R.q_load_window_coverage(spark, SF_DIR)


def line_series(spark):
    return R.q_rate_line_series(spark, SF_DIR)


QUERIES = {
    "dedup": dedup("aggregate"),
    "dedup_window": dedup("window"),
    "historical_extremes": extremes(partial(gold.historical_extremes, stamp=False)),
    "historical_extremes_window": extremes(extremes_by_rank),
    "daily_changes": changes(None),
    "daily_changes_split": changes(YEAR),
    "extreme_daily_movements": moves(partial(gold.extreme_daily_movements, stamp=False)),
    "extreme_daily_movements_window": moves(moves_by_rank),
    "extreme_daily_movements_split": moves(partial(gold.extreme_daily_movements, stamp=False), YEAR),
    "biggest_appreciation": appreciation("aggregate"),
    "biggest_appreciation_window": appreciation("window"),
    "biggest_appreciation_split": appreciation_split,
    "executive_summary": summary_fused,
    "executive_summary_tables": summary_tables,
    "quality_report": report,
    "silver_verdict": verdict,
    "load_window_coverage": coverage,
    "rate_line_series": line_series,
}


def run(spark, build) -> float:
    t0 = time.perf_counter()
    build(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=PARTS, app="daybook-bench")
    only = set(sys.argv[1:])
    chosen = {n: b for n, b in QUERIES.items() if not only or n in only}
    for _ in range(WARMUP):
        for build in chosen.values():
            run(spark, build)
    samples = {n: [] for n in chosen}
    for _ in range(RUNS):
        for name, build in chosen.items():
            samples[name].append(run(spark, build))
    times = {n: round(statistics.median(x), 4) for n, x in samples.items()}
    variants = ("_window", "_split")
    headline = [n for n in times if not n.endswith(variants) and n != "executive_summary_tables"]
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times[n] for n in headline), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "config": {
            "spark": spark.version,
            "cores": CPUS,
            "shuffle_partitions": PARTS,
            "runs": RUNS,
            "warmup": WARMUP,
            "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
        },
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
