"""Date strings, position intervals and the years they cover.

Dates are text such as ``2008-02-01``; only the year counts. A position is
*dated* when its start has a readable year and its end is either absent or
readable too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerloom.schema import END_YEAR, POSITION_COLUMNS, START_YEAR

# Any whole number in front of the delimiter that fits an int.
_YEAR = r"^([+]?[0-9]+)(?:%s|\z)"
# Years of a block: a block's years, and the blocks of all years there are, make arrays of bounded size.
_BLOCK = 1 << 16


def _leading_year(date: Column, delimiter: str) -> Column:
    return F.regexp_extract(date, _YEAR % delimiter, 1).try_cast("int")


def date_year(date: Column) -> Column:
    """Year in front of the first '-'; null when that text is not a year."""
    return _leading_year(date, "-")


def normalize_date(date: Column) -> Column:
    """Dates written with '/' get '-' instead."""
    return F.replace(date, F.lit("/"), F.lit("-"))


def position_interval(
    position: Column, start_year: int = START_YEAR, end_year: int = END_YEAR
) -> Column:
    """Struct (from_year, to_year); either is null when the date is unusable.

    The start is clamped to ``start_year``; a missing end means ``end_year``.
    The current flag plays no part and the end is not clamped. Dates may still
    be written with '/'.
    """
    start, end = _leading_year(position["start_date"], "[-/]"), position["end_date"]
    return F.struct(
        F.when(start < start_year, F.lit(start_year)).otherwise(start).alias("from_year"),
        F.when(end.isNull(), F.lit(end_year)).otherwise(_leading_year(end, "[-/]")).alias("to_year"),
    )


def position_interval_current(
    position: Column, start_year: int = START_YEAR, end_year: int = END_YEAR
) -> Column:
    """Like :func:`position_interval`, but led by the current flag.

    A current position lasts until ``end_year``; any other needs an end date.
    Dates written with '/' have no readable year here.
    """
    start = date_year(position["start_date"])
    return F.struct(
        F.when(start < start_year, F.lit(start_year)).otherwise(start).alias("from_year"),
        F.when(F.coalesce(position["is_current"], F.lit(False)), F.lit(end_year))
        .otherwise(date_year(position["end_date"]))
        .alias("to_year"),
    )


def _position_fields(positions: str, fields: Iterable[str]) -> Column:
    """Array of structs with the given fields of the positions.

    Taking each field on its own lets a columnar scan skip the others, of which
    the free text is most of a profile.
    """
    return F.arrays_zip(*[F.col(f"{positions}.{field}") for field in fields])


def dated_positions(
    positions: str = "positions",
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    fields: Iterable[str] = POSITION_COLUMNS,
) -> Column:
    """Array of the dated positions in list order, with from_year and to_year.

    ``fields`` are the position fields to carry along; with an empty list only
    the dates are read.
    """
    fields = list(fields)
    read = list(dict.fromkeys([*fields, "start_date", "end_date"]))

    def with_interval(p: Column) -> Column:
        interval = position_interval(p, start_year, end_year)
        return F.struct(
            *[p[f].alias(f) for f in fields],
            interval["from_year"].alias("from_year"),
            interval["to_year"].alias("to_year"),
        )

    return F.filter(
        F.transform(_position_fields(positions, read), with_interval),
        lambda p: p["from_year"].isNotNull() & p["to_year"].isNotNull(),
    )


def first_year(dated: Column) -> Column:
    return F.array_min(dated["from_year"])


def last_year(dated: Column) -> Column:
    return F.array_max(dated["to_year"])


def unfold_years(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per year ``first..last`` in ``year``; none when ``last`` lies before ``first``.

    Unfolds blocks of years, then the years of a block, so that no row holds a long array however
    far a span reaches.
    """
    low, high = F.col(first).cast("bigint"), F.col(last).cast("bigint")
    blocks = F.when(high >= low, F.sequence(low, high, F.lit(_BLOCK)))
    years = F.sequence(F.col("_block"), F.least(F.col("_block") + (_BLOCK - 1), high))
    return (
        df.withColumn("_block", F.explode(blocks))
        .withColumn("year", F.explode(years))
        .withColumn("year", F.col("year").cast("int"))
        .drop("_block")
    )


def active_positions(dated: Column, year: Column) -> Column:
    """Dated positions that cover ``year``, in list order."""
    return F.filter(dated, lambda p: (p["from_year"] <= year) & (year <= p["to_year"]))


def is_active_in(
    year: int, positions: str = "positions", start_year: int = START_YEAR, end_year: int = END_YEAR
) -> Column:
    """True when some dated position covers ``year``."""

    def covers(p: Column) -> Column:
        interval = position_interval(p, start_year, end_year)
        inside = (interval["from_year"] <= year) & (interval["to_year"] >= year)
        return F.coalesce(inside, F.lit(False))

    return F.exists(_position_fields(positions, ["start_date", "end_date"]), covers)


def normalize_positions(positions: Column) -> Column:
    """Dates of all positions with '-'; the summary of dated ones is dropped."""
    return F.transform(
        positions,
        lambda p: F.struct(
            F.when(p["start_date"].isNull(), p["summary"]).alias("summary"),
            p["title"].alias("title"),
            normalize_date(p["start_date"]).alias("start_date"),
            F.when(p["start_date"].isNull(), p["end_date"])
            .otherwise(normalize_date(p["end_date"]))
            .alias("end_date"),
            F.coalesce(p["is_current"], F.lit(False)).alias("is_current"),
            p["company_name"].alias("company_name"),
        ),
    )


def has_bad_year(positions: Column) -> Column:
    """True when a position with a start date has a start or end year that cannot be read."""
    return F.exists(
        positions,
        lambda p: p["start_date"].isNotNull()
        & (
            _leading_year(p["start_date"], "[-/]").isNull()
            | (p["end_date"].isNotNull() & _leading_year(p["end_date"], "[-/]").isNull())
        ),
    )
