"""Sectors of industries, skills and profiles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.functions import (
    clean_connections,
    clean_tag,
    missing_sector,
    normalize_positions,
)
from careerloom.schema import SECTORS


def clean_lookup(industry_sector: DataFrame) -> DataFrame:
    """Lookup keyed by cleaned industry; keys that become equal take the first sector name."""
    return industry_sector.groupBy(clean_tag(F.col("industry")).alias("industry")).agg(
        F.min("sector").alias("sector")
    )


def industry_sector_join(df: DataFrame, industry_sector: DataFrame) -> DataFrame:
    """Add the sector of each row's industry; rows with an unmapped one are dropped."""
    return df.join(industry_sector.select("industry", "sector"), "industry")


def skill_sector_join(
    profiles: DataFrame,
    tag_sector: DataFrame,
    id_col: str = "pid",
    normalize: bool = False,
) -> DataFrame:
    """(id, pos, skill, sector) for each skill that has a sector.

    Skills are looked up as written; ``normalize`` cleans them first. The tag
    table grows with the data, so it is not hinted: Spark broadcasts it when it
    is small and else shuffles both sides, splitting a skill that is very common.
    """
    skills = profiles.select(id_col, F.posexplode("skills").alias("pos", "skill"))
    if normalize:
        skills = skills.withColumn("skill", clean_tag(F.col("skill")))
    return skills.join(
        tag_sector.select(F.col("tag").alias("skill"), "sector"), "skill"
    ).select(id_col, "pos", "skill", "sector")


def dominant_skill_sector(
    profiles: DataFrame,
    tag_sector: DataFrame,
    id_col: str = "pid",
    normalize: bool = False,
) -> DataFrame:
    """(id, sector): the sector most of a profile's skills have.

    Among equals the one that reaches that count first in list order wins.
    Profiles without a known skill are absent.
    """
    best = F.min(F.struct((-F.col("_skills")).alias("neg_skills"), "_last_pos", "sector"))
    return (
        skill_sector_join(profiles, tag_sector, id_col, normalize)
        .groupBy(id_col, "sector")
        .agg(F.count("*").alias("_skills"), F.max("pos").alias("_last_pos"))
        .groupBy(id_col)
        .agg(best["sector"].alias("sector"))
    )


def assign_sector(
    profiles: DataFrame,
    industry_sector: DataFrame,
    tag_sector: DataFrame,
    id_col: str = "pid",
    normalize: bool = False,
) -> DataFrame:
    """Add ``sector``: that of the industry, else that of most skills, else null.

    Only profiles whose industry is missing or unmapped take the skill path, so
    the others are never shuffled. ``profiles`` is read once per path: pass a
    table, not a costly query. ``normalize`` looks up cleaned industries
    and skills instead of the text as written.
    """
    lookup = clean_lookup(industry_sector) if normalize else industry_sector
    lookup = lookup.select(F.col("industry").alias("_industry"), "sector")
    key = clean_tag(F.col("industry")) if normalize else F.col("industry")
    looked_up = profiles.join(lookup, key == F.col("_industry"), "left").drop("_industry")
    mapped = looked_up.filter(F.col("sector").isNotNull())
    unmapped = looked_up.filter(F.col("sector").isNull()).drop("sector")
    by_skill = dominant_skill_sector(unmapped, tag_sector, id_col, normalize)
    return mapped.unionByName(unmapped.join(by_skill, id_col, "left"))


def prune_profile(assigned: DataFrame) -> DataFrame:
    """The sector takes the industry's place; connections and dates are cleaned up.

    Summaries of positions with a start date are dropped.
    """
    return (
        assigned.withColumn("industry", F.col("sector"))
        .withColumn("num_connections", clean_connections(F.col("num_connections")))
        .withColumn("positions", normalize_positions(F.col("positions")))
    )


def require_sector(df: DataFrame, sector_col: str = "sector") -> DataFrame:
    """Drop rows whose sector is null, blank or the text 'null'."""
    return df.filter(~missing_sector(F.col(sector_col)))


def valid_sector(
    df: DataFrame, sector_col: str = "sector", sectors: Iterable[str] = SECTORS
) -> DataFrame:
    """Keep rows whose sector is in the vocabulary."""
    return df.filter(F.col(sector_col).isin(list(sectors)))
