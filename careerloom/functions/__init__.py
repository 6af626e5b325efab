"""Column expressions shared by the operators."""

from careerloom.functions.dates import (
    active_positions,
    date_year,
    dated_positions,
    first_year,
    has_bad_year,
    is_active_in,
    last_year,
    normalize_date,
    normalize_positions,
    position_interval,
    position_interval_current,
    unfold_years,
)
from careerloom.functions.text import (
    clean_connections,
    clean_tag,
    connection_count,
    has_tag,
    is_blank,
    missing_sector,
    split_fields,
    strip_blanks,
)

__all__ = [
    "active_positions",
    "clean_connections",
    "clean_tag",
    "connection_count",
    "date_year",
    "dated_positions",
    "first_year",
    "has_bad_year",
    "has_tag",
    "is_active_in",
    "is_blank",
    "last_year",
    "missing_sector",
    "normalize_date",
    "normalize_positions",
    "position_interval",
    "position_interval_current",
    "split_fields",
    "strip_blanks",
    "unfold_years",
]
