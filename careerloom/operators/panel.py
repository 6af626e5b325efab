"""Positions and profiles unfolded by year, and the rows of the year store."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerloom.functions import (
    active_positions,
    dated_positions,
    first_year,
    is_active_in,
    last_year,
    missing_sector,
    position_interval,
    position_interval_current,
    unfold_years,
)
from careerloom.operators.sectors import require_sector
from careerloom.schema import END_YEAR, POSITION_COLUMNS, START_YEAR
from careerloom.sources.outputs import written_table


def position_years(
    profiles: DataFrame,
    keep: Sequence[str] = ("pid",),
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    interval=position_interval,
) -> DataFrame:
    """One row per position and covered year: kept columns, position_no, year."""
    span = interval(F.col("_position"), start_year, end_year)
    spans = profiles.select(*keep, F.posexplode("positions").alias("position_no", "_position")).select(
        *keep, "position_no", span["from_year"].alias("_from"), span["to_year"].alias("_to")
    )
    return unfold_years(spans, "_from", "_to").select(*keep, "position_no", "year")


def position_year_counts(
    profiles: DataFrame, start_year: int = START_YEAR, end_year: int = END_YEAR
) -> DataFrame:
    """(year, n_positions), where a current position lasts until ``end_year``."""
    years = position_years(profiles, (), start_year, end_year, position_interval_current)
    return years.groupBy("year").agg(F.count("*").alias("n_positions"))


def active_in_year(
    profiles: DataFrame, year: int, start_year: int = START_YEAR, end_year: int = END_YEAR
) -> DataFrame:
    """Profiles with at least one dated position that covers ``year``."""
    return profiles.filter(is_active_in(year, "positions", start_year, end_year))


def spans_year(
    profiles: DataFrame, year: int, start_year: int = START_YEAR, end_year: int = END_YEAR
) -> DataFrame:
    """Profiles whose span, gap years included, covers ``year``; those without dated positions in year 0."""
    dated = dated_positions("positions", start_year, end_year, ())
    first, last = first_year(F.col("_dated")), last_year(F.col("_dated"))
    covered = (first <= year) & (last >= year) | ((F.size("_dated") == 0) & (F.lit(year) == 0))
    return profiles.withColumn("_dated", dated).filter(covered).drop("_dated")


def profile_year_panel(
    profiles: DataFrame,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    position_fields: Iterable[str] = POSITION_COLUMNS,
) -> DataFrame:
    """One row per profile and year of its span, gap years included.

    The span runs from the earliest start to the latest end of the dated
    positions. Each row has ``year``, ``relevant_experience`` (years since the
    span began) and, as ``positions``, those active that year. Everything
    happens inside the row, so nothing is shuffled. With few
    ``position_fields`` the other text of positions is not even read.
    """
    kept = [c for c in profiles.columns if c not in ("positions", "relevant_experience")]
    dated = dated_positions("positions", start_year, end_year, position_fields)
    active = active_positions(F.col("_dated"), F.col("year")).alias("positions")
    spans = profiles.select(*kept, dated.alias("_dated")).select(
        *kept, "_dated", first_year(F.col("_dated")).alias("_first"), last_year(F.col("_dated")).alias("_last")
    )
    experience = (F.col("year") - F.col("_first")).alias("relevant_experience")
    return unfold_years(spans, "_first", "_last").select(*kept, "year", experience, active)


def last_known_position(
    profiles: DataFrame,
    keep: Sequence[str] = ("pid",),
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
) -> DataFrame:
    """Title and company of the last listed position that covers each year of the span.

    Both are empty in a gap year, or where the position does not tell.
    """
    fields = ("title", "company_name")
    panel = profile_year_panel(
        profiles.select(*keep, "positions"), start_year, end_year, fields
    )
    return panel.select(*keep, "year", *_last_known())


def _last_known():
    last = F.try_element_at(F.col("positions"), F.lit(-1))
    return [
        F.coalesce(last["title"], F.lit("")).alias("last_title"),
        F.coalesce(last["company_name"], F.lit("")).alias("last_company"),
    ]


def year_store_rows(
    pruned: DataFrame,
    id_col: str = "pid",
    sector_col: str = "industry",
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    year: int | None = None,
) -> DataFrame:
    """Rows of the year store: one per profile and year of its span.

    A profile without dated positions gets a single row with year 0. With ``year`` only the
    rows of that year are made; the other years are not unfolded.
    Experience is the input's own ``relevant_experience``, or 0.
    """
    text = ["first_name", "last_name", "num_connections", "location"]
    experience = (
        F.coalesce("relevant_experience", F.lit(0))
        if "relevant_experience" in pruned.columns
        else F.lit(0)
    )
    dated = F.col("_dated")
    undated = F.size(dated) == 0
    ends = [
        F.when(undated, F.lit(0)).otherwise(end(dated)).alias(name)
        for end, name in ((first_year, "_first"), (last_year, "_last"))
    ]
    head = [
        F.col(id_col),
        F.coalesce(sector_col, F.lit("")).alias("sector"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in text],
        experience.alias("rel_experience"),
    ]
    names = [id_col, "sector", *text, "rel_experience"]
    fields = ("title", "company_name")
    spans = pruned.select(
        *head, dated_positions("positions", start_year, end_year, fields).alias("_dated")
    ).select(*names, "_dated", *ends)
    if year is None:
        rows = unfold_years(spans, "_first", "_last")
    else:
        rows = spans.withColumn("year", F.lit(year)).filter("_first <= year AND year <= _last")
    return rows.select(*names, "year", active_positions(dated, F.col("year")).alias("positions")).select(
        "year", *names, *_last_known()
    )


def year_store_row_count(rows: DataFrame) -> DataFrame:
    """(n_rows): the number of year-store rows."""
    return rows.agg(F.count("*").alias("n_rows"))


def null_sector_metrics(
    sector_col: str = "sector", start_year: int = START_YEAR, end_year: int = END_YEAR
) -> dict[str, Column]:
    """The aggregates of :func:`null_sector_count`, for a table that is read or one that is being written."""
    dated = dated_positions("positions", start_year, end_year, ())
    years = last_year(dated).cast("bigint") - first_year(dated) + 1
    counted = missing_sector(F.col(sector_col)) & (years > 0)
    return {
        "n_rows": F.coalesce(F.sum(F.when(counted, years)), F.lit(0)),
        "n_profiles": F.count_if(counted),
    }


def null_sector_count(
    profiles: DataFrame,
    sector_col: str = "sector",
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
) -> DataFrame:
    """(n_rows, n_profiles) of the panel that have no sector.

    Taken from the length of each profile's span; the panel is not unfolded and
    no distinct count is needed.
    """
    metrics = null_sector_metrics(sector_col, start_year, end_year)
    return profiles.agg(*(c.alias(name) for name, c in metrics.items()))


def sector_year_order(
    panel: DataFrame, id_col: str = "pid", sector_col: str = "sector"
) -> DataFrame:
    """Panel rows that have a sector, ordered by sector and year, with ``group_no``.

    ``group_no`` numbers the years within each sector. Rows are split by ranges
    of (sector, year, id), so a dominant sector spreads over many tasks. The
    table of groups is written, so Spark knows its size when it joins it.
    """
    known = require_sector(panel, sector_col)
    numbered = Window.partitionBy(sector_col).orderBy("year")
    groups = (
        known.select(sector_col, "year")
        .distinct()
        .withColumn("group_no", F.row_number().over(numbered))
    )
    order = [sector_col, "year", id_col]
    return (
        known.join(written_table(groups), [sector_col, "year"])
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
