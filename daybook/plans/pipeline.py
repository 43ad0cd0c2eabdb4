"""The three layers as runnable steps: bronze ingest, silver, gold + dashboard.

Action budget per run (the data is read as few times as the checks need):

* bronze: watermark (one scalar aggregate); only files that have newly landed
  are read, parsed once and written to staging; the quality report and the
  split into accepted and quarantined records read the staged Parquet (the gate
  collects at most a handful of error rows); each part is published as one
  batch directory;
* silver: one dedup written to staging, one verdict scan of the staged
  files, a rename;
* gold: one write per table; the summary is a view over the written tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import parsed_date
from daybook.operators import gold, marts, quality
from daybook.operators.silver import build_silver
from daybook.sinks.tables import (
    append_table,
    create_or_replace_view,
    discard,
    overwrite_table,
    path_exists,
    quarantine_path,
    read_table,
    stage,
)
from daybook.sources.incremental import batch_bounds, incremental_batch, watermark_value
from daybook.sources.payload import (
    BRONZE_SCHEMA,
    BRONZE_TABLE_SCHEMA,
    CORRUPT,
    SOURCE_FILE,
    flatten_landed,
    quarantine_reason,
    read_landed,
    stamp_ingestion,
)
from daybook.spec import SeriesSpec

RATE_SPEC = SeriesSpec()


@dataclass
class BronzeResult:
    mode: str  # "full", "incremental", "up_to_date" or "empty" (nothing new has landed)
    valid: bool
    report: DataFrame | None
    written: DataFrame | None
    quarantined: int = 0
    outside_window: int = 0  # dated records before the load window, left out


def _ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}.__files"


LEDGER_SCHEMA = "source_file string, modified timestamp, done boolean"


def _landed_files(spark: SparkSession, landing: str, bronze_path: str) -> DataFrame:
    """source_file, modified and ``seen`` of every landed file that is not done.

    Only names are listed (no content is read). A file is done once a run has
    taken all of it; until then (it holds dates beyond that run's ``as_of``)
    later runs read it again, but its rejects were already kept (``seen``). A
    file that was written anew is a new file.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    # the same spelling of a path as in the records read from it
    files = listed.select(F.col("_metadata.file_path").alias("source_file"), F.col("modificationTime").alias("modified"))
    ledger = _ledger_path(bronze_path)
    if not path_exists(spark, ledger):
        return files.withColumn("seen", F.lit(False))
    taken = read_table(spark, ledger, LEDGER_SCHEMA)
    taken = taken.groupBy("source_file", "modified").agg(F.max("done").alias("done"))
    joined = files.join(taken, ["source_file", "modified"], "left").where(~F.coalesce("done", F.lit(False)))
    return joined.select("source_file", "modified", F.col("done").isNotNull().alias("seen"))


def run_bronze(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    as_of: str,
    spec: SeriesSpec = RATE_SPEC,
    expected: DataFrame | None = None,
    run_quality_checks: bool = True,
) -> BronzeResult:
    """Load what has newly landed beyond the bronze watermark, check, append.

    No record is lost: a rate without a valid date is part of the batch that
    is checked, whatever its date; records that do not meet the declared schema
    (malformed payloads, NULLs in its columns) go to the quarantine table with
    reason and source file, the others are appended. The report covers both.
    Rates dated before the load window (at or before the watermark, or older
    than ``years_back``) are left out, as A4 asks; the report and the result
    count them. In strict mode an error row stops the run before anything is
    published; its files stay unread for the next run.

    The list of files stays a table: it is joined with the records, and only its
    earliest modification time comes to the driver, to skip older files unread.
    """
    exists = path_exists(spark, bronze_path)
    wm = watermark_value(read_table(spark, bronze_path, BRONZE_TABLE_SCHEMA), spec.d) if exists else None
    if wm is not None and wm >= as_of:
        return BronzeResult("up_to_date", True, None, None)
    names = _landed_files(spark, landing, bronze_path).checkpoint(eager=True)  # this run's files
    earliest = names.agg(F.date_format(F.min("modified") - F.expr("interval 1 second"), "yyyy-MM-dd'T'HH:mm:ss").alias("t")).first()["t"]
    if earliest is None:
        return BronzeResult("empty", True, None, None)
    landed = read_landed(spark, landing, modified_after=earliest)
    rows = flatten_landed(landed).join(names.select(SOURCE_FILE, "seen"), SOURCE_FILE)
    dated = parsed_date(spec.d).isNotNull()
    due = incremental_batch(rows, spec.d, as_of, watermark=wm, years_back=spec.years_back).where(dated)
    undated = rows.where(~dated & ~F.col("seen"))
    tagged = due.unionByName(undated).withColumn("quarantine_reason", quarantine_reason(BRONZE_SCHEMA.names))
    batch = tagged.select(*BRONZE_SCHEMA.names, CORRUPT, SOURCE_FILE, "quarantine_reason")
    # parsed once, into staging beside the table; the report and the split read the staged files
    staged = stage(stamp_ingestion(batch), f"{bronze_path.rstrip('/')}.__batch")
    try:
        checked = read_table(spark, staged)
        counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count("quarantine_reason").alias("bad"), F.count(CORRUPT).alias("malformed")).first()
        # per file: dates that a later run takes, and those that no run will
        low, _, inclusive = batch_bounds(as_of, wm, spec.years_back)
        before = (F.col(spec.d) < low) if inclusive else (F.col(spec.d) <= low)
        by_file = rows.where(dated).groupBy(SOURCE_FILE).agg(F.count_if(F.col(spec.d) > F.lit(as_of)).alias("later"), F.count_if(before & ~F.col("seen")).alias("before"))
        by_file = by_file.checkpoint(eager=True)
        outside = by_file.agg(F.coalesce(F.sum("before"), F.lit(0)).alias("n")).first()["n"]
        report = None
        valid = True
        if run_quality_checks and counts["n"]:
            report = quality.quality_report(checked.where(F.col(CORRUPT).isNull()), spec, expected=expected)
            report = report.unionByName(quality.malformed_row(spark, counts["malformed"], counts["n"]))
            report = report.unionByName(quality.outside_window_row(spark, outside, outside + counts["n"]))
            # kept in the shared folder: the files it reads are removed below
            report = report.checkpoint(eager=True)
            valid = quality.enforce(report, strict=spec.thresholds.strict_mode)
        if counts["bad"]:
            append_table(checked.where("quarantine_reason is not null"), quarantine_path(bronze_path))
        written = None
        if counts["n"] > counts["bad"]:
            append_table(checked.where("quarantine_reason is null").select(*BRONZE_TABLE_SCHEMA.names), bronze_path)
            written = read_table(spark, bronze_path, BRONZE_TABLE_SCHEMA).agg(
                F.lit(counts["n"] - counts["bad"]).cast("long").alias("written"), F.count(F.lit(1)).alias("table_total")
            )
        taken = names.join(by_file, SOURCE_FILE, "left").select(SOURCE_FILE, "modified", (F.coalesce("later", F.lit(0)) == 0).alias("done"))
        append_table(taken.coalesce(1), _ledger_path(bronze_path))
    finally:
        discard(spark, staged)
    mode = "empty" if not counts["n"] else "incremental" if wm is not None else "full"
    return BronzeResult(mode, valid, report, written, counts["bad"], outside)


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, spec: SeriesSpec = RATE_SPEC) -> DataFrame:
    """Rebuild silver from all of bronze; hard gate; replace the table."""
    return build_silver(read_table(spark, bronze_path, merge=True), spec, silver_path)


def run_gold(spark: SparkSession, silver_path: str, gold_dir: str, spec: SeriesSpec = RATE_SPEC) -> dict[str, DataFrame]:
    """Write the three gold tables, register the summary view, return all."""
    silver = read_table(spark, silver_path).select(*spec.series_cols)
    g = gold_dir.rstrip("/")
    extremes = overwrite_table(gold.historical_extremes(silver, spec), f"{g}/historical_extremes")
    changes = overwrite_table(gold.daily_changes(silver, spec), f"{g}/daily_changes")
    movements = overwrite_table(gold.extreme_daily_movements(changes, spec), f"{g}/extreme_daily_movements")
    summary = create_or_replace_view(gold.executive_summary(extremes, movements, spec), "executive_summary")
    return {
        "historical_extremes": extremes,
        "daily_changes": changes,
        "extreme_daily_movements": movements,
        "executive_summary": summary,
        "record_counts": gold.gold_record_counts(extremes, changes, movements),
    }


def dashboard(spark: SparkSession, silver_path: str, spec: SeriesSpec = RATE_SPEC) -> dict[str, DataFrame]:
    """The dashboard's datasets; like the original they read silver."""
    silver = read_table(spark, silver_path)
    series = silver.select(*spec.series_cols)
    return {
        "biggest_appreciation": marts.biggest_appreciation(series, spec),
        "biggest_depreciation": marts.biggest_depreciation(series, spec),
        "highest_rates": marts.highest_rates(series, spec),
        "lowest_rates": marts.lowest_rates(series, spec),
        "rate_line_series": marts.rate_line_series(series, spec),
        "row_count": marts.series_row_count(silver, [spec.k]),
    }
