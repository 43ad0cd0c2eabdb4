"""Nested rate payloads: read, flatten, enforce the declared bronze schema.

A payload is one JSON object per key and load window::

    {"code": ..., "currency": ..., "table": ...,
     "rates": [{"no": ..., "effectiveDate": ..., "mid": ...}, ...]}

Landed payload files are read with an explicit schema (no inference pass) and
flattened with ``inline`` - one row per element of ``rates``, parent fields
repeated; a payload without ``rates`` yields nothing. The JSON reader binds
fields by name and turns an integer ``mid`` into a double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Field names of the payload and of the bronze table.
RATE_SCHEMA = T.StructType(
    [
        T.StructField("no", T.StringType()),
        T.StructField("effectiveDate", T.StringType()),
        T.StructField("mid", T.DoubleType()),
    ]
)
PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("rates", T.ArrayType(RATE_SCHEMA)),
    ]
)
# Declared bronze columns; read as nullable so violations can be counted
# and quarantined instead of failing the whole batch.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("currency_code", T.StringType()),
        T.StructField("currency_name", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("no", T.StringType()),
        T.StructField("effectiveDate", T.StringType()),
        T.StructField("mid", T.DoubleType()),
    ]
)
INGESTION_TS = "ingestion_timestamp"
SOURCE_FILE = "source_file"
# The stored bronze table: the declared columns and the stamp.
BRONZE_TABLE_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(INGESTION_TS, T.TimestampType())])


# ---------------------------------------------------------------- A1


def read_payloads(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed payload files (JSON lines) with the payload schema."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path if isinstance(path, str) else list(path))


def landed_reader(reader):
    """A batch or stream reader that keeps the text of malformed records."""
    full = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def with_source_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_landed(spark: SparkSession, path: str | Sequence[str], modified_after: str | None = None) -> DataFrame:
    """``read_payloads`` with the text of malformed records (``_corrupt_record``)
    and the file of every record (``source_file``); optionally only files
    modified after a time (``yyyy-MM-ddTHH:mm:ss``, session time zone)."""
    reader = landed_reader(spark.read).option("recursiveFileLookup", "true")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return with_source_file(reader.json(path if isinstance(path, str) else list(path)))


def flatten_landed(landed: DataFrame) -> DataFrame:
    """A1 on ``read_landed`` rows: one row per rate, and one for every malformed
    record (all columns NULL but its text and file), so none is lost."""
    rates = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(None).cast(RATE_SCHEMA))).otherwise(F.col("rates"))
    return landed.select(
        F.col("code").alias("currency_code"),
        F.col("currency").alias("currency_name"),
        F.col("table"),
        CORRUPT,
        SOURCE_FILE,
        F.inline(rates),
    )


def flatten_payload(payloads: DataFrame) -> DataFrame:
    """A1: one bronze row per rate; parent fields repeated."""
    return payloads.select(
        F.col("code").alias("currency_code"),
        F.col("currency").alias("currency_name"),
        F.col("table"),
        F.inline(F.col("rates")),
    )


def parse_payloads(texts: DataFrame, col: str = "value") -> DataFrame:
    """Payload JSON strings in a column -> payload structs (same parser)."""
    return texts.select(F.from_json(F.col(col), PAYLOAD_SCHEMA).alias("_p")).select("_p.*")


def payload_texts(
    rows: DataFrame,
    parent: dict[str, Column],
    child: dict[str, Column],
    max_children: int = 256,
) -> DataFrame:
    """Nest flat rows into payload JSON strings (a landing-zone writer).

    Consecutive rows of an input partition that share the parent fields go
    into one payload of at most ``max_children`` rates, as a paging API would
    return them. The bound holds by construction (a run of ids), so no key,
    however hot, is gathered into one array.
    """
    run = F.floor(F.monotonically_increasing_id() / F.lit(max_children))
    flat = rows.select(
        *[c.alias(n) for n, c in parent.items()],
        run.alias("_run"),
        F.struct(*[c.alias(n) for n, c in child.items()]).alias("_rate"),
    )
    nested = flat.groupBy(*parent.keys(), "_run").agg(F.collect_list("_rate").alias("rates"))
    return nested.select(F.to_json(F.struct(*parent.keys(), "rates")).alias("value"))


# ---------------------------------------------------------------- A2


def read_declared(
    spark: SparkSession, path: str, schema: T.StructType = BRONZE_SCHEMA, fmt: str = "json"
) -> DataFrame:
    """Read landed flat records with the declared schema; malformed records
    keep their text in ``_corrupt_record`` instead of failing the read."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .format(fmt)
        .load(path)
    )


def parse_declared(texts: DataFrame, schema: T.StructType = BRONZE_SCHEMA, col: str = "value") -> DataFrame:
    """``read_declared`` for JSON strings already in a column."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return texts.select(parsed.alias("_r")).select("_r.*")


def quarantine_reason(required: Sequence[str]) -> Column:
    """NULL for a conforming row, else why it is rejected."""
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"null:{c}"))
    return reason


def declared_split(
    parsed: DataFrame, required: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """A2: (accepted, quarantined). Accepted rows satisfy the declared
    non-NULL columns; quarantined rows carry ``quarantine_reason``. Unlike an
    all-or-nothing batch check, one bad value costs one row."""
    cols = [c for c in parsed.columns if c != CORRUPT]
    required = list(required) if required is not None else cols
    tagged = parsed.withColumn("quarantine_reason", quarantine_reason(required))
    accepted = tagged.where(F.col("quarantine_reason").isNull()).select(*cols)
    quarantined = tagged.where(F.col("quarantine_reason").isNotNull())
    return accepted, quarantined


def declared_status(parsed: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Every parsed row with its ``status`` (accepted / quarantined) and reason."""
    cols = [c for c in parsed.columns if c != CORRUPT]
    required = list(required) if required is not None else cols
    reason = quarantine_reason(required)
    return parsed.select(
        *cols,
        F.when(reason.isNull(), F.lit("accepted")).otherwise(F.lit("quarantined")).alias("status"),
        reason.alias("quarantine_reason"),
    )


# ---------------------------------------------------------------- A6


def stamp_ingestion(df: DataFrame, col: str = INGESTION_TS) -> DataFrame:
    """Constant load timestamp for the whole batch."""
    return df.withColumn(col, F.current_timestamp())
