"""Write docs/PLANS.md: final physical plans of the headline queries.

Each query is executed once (so the adaptive plan is final) and its
``explain("formatted")``-style tree is recorded with a short note.
Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from daybook.plans import bindings as B  # noqa: E402
from daybook.plans import registry as R  # noqa: E402
from daybook.plans.session import local_session  # noqa: E402
from daybook.sinks.tables import scratch_path  # noqa: E402
from daybook.sources import incremental  # noqa: E402

NOTES = {
    "executive_summary": "dedup (partial max before the (key, date) shuffle), the lag per key, and one key aggregate "
    "in the lag's own partitioning: two shuffles, no join.",
    "quality_report": "one scan of orders, one of customer; (key, date) aggregate, then rollup(key) with the "
    "expected keys unioned in; one generator emits all report rows.",
    "latest_per_key_supp": "partial + final max(struct) around one (key, date) shuffle.",
    "load_window_coverage": "one aggregate with a count per window, left join with the expected keys, "
    "unpivot; no cross product.",
    "incremental_batch_stored": "bronze stored with a string date: the batch bounds are literals and appear "
    "in PushedFilters.",
}


def tree(df) -> str:
    # run this DataFrame's own query execution (a write would plan a new
    # one), so the printed adaptive plan is the final one; sf0.01 results
    # are small enough for a documentation tool to collect
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    out = ["# Physical plans", "", f"Final adaptive plans at `{os.path.basename(sf)}`, local[8], "
           "generated by `python tools/plans.py`.", ""]
    frames = {name: R.QUERIES[name](spark, sf) for name in
              ("executive_summary", "quality_report", "latest_per_key_supp", "load_window_coverage")}
    b, spec = B.orders_bronze(spark, sf)
    stored = scratch_path(spark, "plans-bronze")
    b.write.parquet(stored)
    frames["incremental_batch_stored"] = incremental.incremental_batch(
        spark.read.parquet(stored), spec.d, R.INCREMENTAL_AS_OF, watermark="1998-12-31"
    )
    for name, df in frames.items():
        text = tree(df).replace(sf, "<sf>").replace(stored, "<stored>")
        out += [f"## {name}", "", NOTES[name], "", "```", text.rstrip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
