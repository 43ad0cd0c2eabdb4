"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from daybook.functions.columns import (
    ascending_key,
    descending_key,
    parsed_date,
    percentage,
    rounded_percentage,
    safe_ratio_pct,
)

__all__ = [
    "ascending_key",
    "descending_key",
    "parsed_date",
    "percentage",
    "rounded_percentage",
    "safe_ratio_pct",
]
