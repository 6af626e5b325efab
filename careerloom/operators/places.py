"""Countries of locations, and headcounts by sector and country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.operators.panel import active_in_year, spans_year
from careerloom.operators.sectors import require_sector
from careerloom.schema import END_YEAR, START_YEAR
from careerloom.sources.stores import year_store_scan


def location_tokens(df: DataFrame, keep: Sequence[str] = ("pid",)) -> DataFrame:
    """(kept columns, pos, token): the words of ``location``, split at single spaces."""
    tokens = F.split(F.rtrim("location"), " ")
    return df.select(*keep, F.posexplode(tokens).alias("pos", "token"))


def resolve_country(
    df: DataFrame, places: DataFrame, keep: Sequence[str] = ("pid",)
) -> DataFrame:
    """(kept columns, country): the country of the first location word that is a place.

    Each distinct location is resolved once. Rows without a known place are absent.
    """
    first = F.min(F.struct("pos", "country"))
    countries = (
        location_tokens(df.select("location").distinct(), ["location"])
        .join(places, "token")
        .groupBy("location")
        .agg(first["country"].alias("country"))
    )
    return df.join(countries, "location").select(*keep, "country")


def sector_country_counts(
    df: DataFrame, places: DataFrame, sector_col: str = "sector"
) -> DataFrame:
    """(sector, country, n_profiles) over the rows of ``df``.

    Rows are counted per sector and location first, so a location is resolved
    once, not once per person.
    """
    heads = df.groupBy(F.col(sector_col).alias("sector"), "location").agg(
        F.count("*").alias("_heads")
    )
    return (
        resolve_country(heads, places, ["sector", "location", "_heads"])
        .groupBy("sector", "country")
        .agg(F.sum("_heads").alias("n_profiles"))
    )


def sector_country_active(
    pruned: DataFrame,
    places: DataFrame,
    year: int,
    sector_col: str = "industry",
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
) -> DataFrame:
    """Headcount by sector and country of the profiles with a position in ``year``."""
    active = active_in_year(require_sector(pruned, sector_col), year, start_year, end_year)
    return sector_country_counts(active, places, sector_col)


def sector_country_span(store: DataFrame, places: DataFrame, year: int) -> DataFrame:
    """Headcount by sector and country of the year store's rows for ``year``.

    Gap years within a profile's span count here, but not in
    :func:`sector_country_active`.
    """
    return sector_country_counts(year_store_scan(store, year), places, "industry")


def sector_country_spanning(
    pruned: DataFrame,
    places: DataFrame,
    year: int,
    sector_col: str = "industry",
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
) -> DataFrame:
    """The counts of :func:`sector_country_span` straight from the profiles, without unfolding their years."""
    spanning = spans_year(require_sector(pruned, sector_col), year, start_year, end_year)
    return sector_country_counts(spanning, places, sector_col)
