"""Sources and incremental loading."""

from daybook.sources.incremental import (
    add_years,
    batch_bounds,
    high_watermark,
    incremental_batch,
    load_window_coverage,
    load_windows,
    watermark_value,
)
from daybook.sources.payload import (
    BRONZE_SCHEMA,
    PAYLOAD_SCHEMA,
    declared_split,
    declared_status,
    flatten_payload,
    parse_declared,
    parse_payloads,
    payload_texts,
    read_declared,
    read_payloads,
    stamp_ingestion,
)

__all__ = [
    "BRONZE_SCHEMA",
    "PAYLOAD_SCHEMA",
    "add_years",
    "batch_bounds",
    "declared_split",
    "declared_status",
    "flatten_payload",
    "high_watermark",
    "incremental_batch",
    "load_window_coverage",
    "load_windows",
    "parse_declared",
    "parse_payloads",
    "payload_texts",
    "read_declared",
    "read_payloads",
    "stamp_ingestion",
    "watermark_value",
]
