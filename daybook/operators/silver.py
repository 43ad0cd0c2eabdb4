"""Silver step: keep the newest version of every (key, date), prune, stamp.

Scale notes
-----------
``latest_per_key`` is written as one grouped ``max(struct(order..., row...))``
aggregate. Spark plans it as a *partial* aggregate before the shuffle on the
business key and a final one after it, so a (key, date) that holds millions of
copies is collapsed to one row per map task before anything moves; no task
ever receives a whole hot group. The ``row_number`` window form is kept as the
literal reading of the semantics (tests and the benchmark compare the two).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.spec import SeriesSpec

PROCESSING_TS = "processing_timestamp"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    method: str = "aggregate",
) -> DataFrame:
    """One row per ``keys``: the row that is greatest by ``order_cols``.

    ``order_cols`` are compared descending with NULLs last (newest first).
    With ``method="aggregate"`` ties on ``order_cols`` are broken by the rest
    of the row, so the result is deterministic even for a partial order.
    """
    keys, order_cols = list(keys), list(order_cols)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
        return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    # struct max: NULL fields compare smallest, NaN largest -> DESC NULLS LAST
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]
    fields += [F.col(c).alias(f"p{i}") for i, c in enumerate(rest)]
    top = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_top"))
    pick: dict[str, Column] = {c: F.col(c) for c in keys}
    pick.update({c: F.col(f"_top.o{i}").alias(c) for i, c in enumerate(order_cols)})
    pick.update({c: F.col(f"_top.p{i}").alias(c) for i, c in enumerate(rest)})
    return top.select(*[pick[c] for c in df.columns])


def dedup_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """initial, final and removed row counts of a dedup, without running it.

    ``count(DISTINCT struct(keys))`` counts keys that hold NULLs, as the dedup
    keeps one row for them; the multi-argument form would skip them.
    """
    s = df.agg(
        F.count(F.lit(1)).alias("initial_count"),
        F.count_distinct(F.struct(*keys)).alias("final_count"),
    )
    removed = F.col("initial_count") - F.col("final_count")
    return s.select(
        "initial_count",
        "final_count",
        removed.alias("duplicates_removed"),
        F.when(F.col("initial_count") > 0, removed.cast("double") / F.col("initial_count") * 100.0)
        .otherwise(0.0)
        .alias("removed_percentage"),
    )


def prune_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def stamp_processing(df: DataFrame, col: str = PROCESSING_TS) -> DataFrame:
    """Constant per-query processing time (``current_timestamp`` is folded once)."""
    return df.withColumn(col, F.current_timestamp())


def silver_frame(bronze: DataFrame, spec: SeriesSpec, method: str = "aggregate") -> DataFrame:
    """C1 -> C3 -> C4 as one lazy plan (no gate, no write). Columns are pruned
    before the dedup: its aggregate would carry, and the scan read, every one."""
    needed = list(dict.fromkeys([*spec.series_cols, *spec.order_cols]))
    latest = latest_per_key(bronze.select(*needed), spec.business_key, spec.order_cols, method=method)
    return stamp_processing(prune_columns(latest, spec.series_cols))


def build_silver(bronze: DataFrame, spec: SeriesSpec, path: str, method: str = "aggregate") -> DataFrame:
    """Whole silver step: dedup, prune, stamp, gate, replace the table at ``path``.

    The dedup runs exactly once: the result is written to a staging directory,
    the verdict (B9) reads the staged files, and only a passing result is
    published to ``path``. Returns the published table.
    """
    from daybook.operators.quality import enforce_verdict, silver_verdict
    from daybook.sinks.tables import discard, publish_staged, stage

    spark = bronze.sparkSession
    silver = silver_frame(bronze, spec, method=method)
    staged = stage(silver, path)
    try:
        enforce_verdict(silver_verdict(spark.read.parquet(staged), spec))
    except Exception:
        discard(spark, staged)  # a failed run leaves the target and no staging behind
        raise
    return publish_staged(spark, staged, path)
