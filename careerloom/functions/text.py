"""String expressions: tag cleaning, blank tests, delimited fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as surrounding white space: everything up to U+0020.
BLANKS = "".join(chr(code) for code in range(0x21))


def strip_blanks(text: Column) -> Column:
    """Trim spaces, tabs and all other control characters from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for null, empty, or white space only."""
    return F.coalesce(strip_blanks(text) == "", F.lit(True))


def clean_tag(text: Column) -> Column:
    """Keep ASCII letters, digits, underscore and space; trim; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9_ ]", ""))


def has_tag(text: Column) -> Column:
    """True when :func:`clean_tag` leaves anything; a search for one such character, with nothing replaced."""
    return F.coalesce(F.rlike(text, F.lit("[A-Za-z0-9_]")), F.lit(False))


def clean_connections(text: Column) -> Column:
    """Connection count as text: null becomes '0', every '+' is removed."""
    return F.coalesce(F.replace(text, F.lit("+"), F.lit("")), F.lit("0"))


def connection_count(text: Column) -> Column:
    """Connection count as an integer; text that is no number counts as 0."""
    return F.coalesce(clean_connections(text).try_cast("int"), F.lit(0))


def split_fields(line: Column) -> Column:
    """Comma-separated fields of a line; trailing empty fields are dropped."""
    return F.split(F.rtrim(line, F.lit(",")), ",")


def missing_sector(sector: Column) -> Column:
    """True where no usable sector is known: null, blank, or the text 'null'."""
    return is_blank(sector) | (sector == "null")
