"""Series specification: which columns hold the key, the date and the value.

Every operator in the package works on a *keyed daily series*: one key column,
one ``yyyy-MM-dd`` string date column and one numeric value column, plus the
columns that order versions of the same (key, date) from newest to oldest.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that define the default series (the rate-table layout and its
# quality thresholds). They must stay as they are for matching results.
DEFAULT_KEY = "currency_code"
DEFAULT_DATE = "effectiveDate"
DEFAULT_VALUE = "mid"
DEFAULT_ORDER = ("ingestion_timestamp",)
DEFAULT_EXPECTED_KEYS = ("USD", "EUR", "GBP", "JPY")
DEFAULT_YEARS_BACK = 5
DATE_PATTERN = "yyyy-MM-dd"


@dataclass(frozen=True)
class Thresholds:
    """Quality gate thresholds (percentages are 0..100)."""

    max_null_percentage: float = 0.0
    max_duplicate_percentage: float = 0.0
    min_expected_records: int = 100
    strict_mode: bool = False


@dataclass(frozen=True)
class SeriesSpec:
    """Column roles of a keyed daily series.

    ``order_cols`` are compared newest-first (descending, NULLs last); the
    first one is the ingestion time in the rate-table layout. Pass a total
    order when versions of one (key, date) can share a timestamp.
    """

    k: str = DEFAULT_KEY
    d: str = DEFAULT_DATE
    v: str = DEFAULT_VALUE
    order_cols: tuple[str, ...] = DEFAULT_ORDER
    expected_keys: tuple[str, ...] = DEFAULT_EXPECTED_KEYS
    thresholds: Thresholds = field(default_factory=Thresholds)
    years_back: int = DEFAULT_YEARS_BACK

    @property
    def business_key(self) -> tuple[str, str]:
        return (self.k, self.d)

    @property
    def series_cols(self) -> tuple[str, str, str]:
        return (self.k, self.d, self.v)

    def with_(self, **changes) -> "SeriesSpec":
        return replace(self, **changes)
