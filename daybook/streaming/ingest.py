"""Continuous bronze ingest of landed payload files.

The batch loader (``plans.pipeline.run_bronze``) finds new data with a date
watermark. Run as a stream instead, the file source's checkpoint remembers
which payload files were already taken, so every landed file is loaded once:

    readStream.json(landing) -> flatten (A1) -> stamp (A6) -> per micro-batch:
    quality report (B8) + gate, then the same split as the batch loader:
    accepted rows to bronze (F1), all others to quarantine

No record is lost: a malformed payload keeps its text and file, and a record
with a NULL in a declared column its values; both go to the bronze table's
quarantine with their reason, and the report counts them. Each micro-batch
writes its accepted rows, its rejects and its report to directories of its own
(``epoch=<id>``) with overwrite, so a batch replayed after a failure replaces
its own output instead of appending it twice. The checkpoint belongs to the
bronze table (``<bronze>.__checkpoint`` unless a location is given): a
restarted ingest goes on with the next epoch and never overwrites an earlier one.

Strict mode: a batch with an error row stops the stream (``on_gate="stop"``,
the same batch is judged again at the next start), or goes to quarantine as a
whole with the reason ``gate`` and the stream goes on (``"quarantine"``), so that
one bad file does not hold up all later ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.operators import quality
from daybook.sinks.tables import quarantine_path, report_path
from daybook.sources.payload import (
    BRONZE_SCHEMA,
    BRONZE_TABLE_SCHEMA,
    CORRUPT,
    flatten_landed,
    landed_reader,
    quarantine_reason,
    stamp_ingestion,
    with_source_file,
)
from daybook.spec import SeriesSpec

EPOCH_COL = "epoch"
GATES = ("stop", "quarantine")


def bronze_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of flattened, stamped rows from ``landing``, malformed
    records among them (their text in ``_corrupt_record``), each with its file."""
    reader = landed_reader(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return stamp_ingestion(flatten_landed(with_source_file(reader.json(landing))))


def _batch_writer(
    bronze_path: str, spec: SeriesSpec, on_report: Callable[[int, DataFrame], None] | None, on_gate: str
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch_id: int) -> None:
        def put(rows: DataFrame, path: str) -> None:
            rows.write.mode("overwrite").parquet(f"{path}/{EPOCH_COL}={epoch_id}")

        # read by the report and by both writes
        batch = batch.withColumn("quarantine_reason", quarantine_reason(BRONZE_SCHEMA.names)).persist()
        counts = batch.agg(F.count(F.lit(1)).alias("n"), F.count("quarantine_reason").alias("bad"), F.count(CORRUPT).alias("malformed")).first()
        report = quality.quality_report(batch.where(F.col(CORRUPT).isNull()), spec)
        report = report.unionByName(quality.malformed_row(batch.sparkSession, counts["malformed"], counts["n"])).persist()
        try:
            if on_report is not None:
                on_report(epoch_id, report)
            put(report.coalesce(1), report_path(bronze_path))
            passed = quality.enforce(report, strict=spec.thresholds.strict_mode and on_gate == "stop")
            if spec.thresholds.strict_mode and not passed:
                batch = batch.withColumn("quarantine_reason", F.coalesce("quarantine_reason", F.lit("gate")))
                counts = {**counts.asDict(), "bad": counts["n"]}
            if counts["bad"]:
                put(batch.where("quarantine_reason is not null"), quarantine_path(bronze_path))
            if counts["n"] > counts["bad"]:
                put(batch.where("quarantine_reason is null").select(*BRONZE_TABLE_SCHEMA.names), bronze_path.rstrip("/"))
        finally:
            report.unpersist()
            batch.unpersist()

    return write


def start_bronze_ingest(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    spec: SeriesSpec,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    on_report: Callable[[int, DataFrame], None] | None = None,
    max_files_per_trigger: int | None = 1000,
    on_gate: str = "stop",
) -> StreamingQuery:
    """Start the ingest. ``available_now`` drains what has landed and stops
    (in micro-batches of at most ``max_files_per_trigger`` files, so a large
    backlog is never one batch); otherwise it polls every ``processing_time``."""
    if on_gate not in GATES:
        raise ValueError(f"on_gate must be one of {GATES}")
    ckpt = checkpoint or f"{bronze_path.rstrip('/')}.__checkpoint"
    w = (
        bronze_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(_batch_writer(bronze_path, spec, on_report, on_gate))
        .option("checkpointLocation", ckpt)
    )
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
