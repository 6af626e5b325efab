"""Skill and title tags, their industries and their sectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerloom.functions import clean_tag, has_tag, is_blank
from careerloom.operators.sectors import clean_lookup, industry_sector_join
from careerloom.schema import TOP_K


def drop_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the rows in which none of ``columns`` is null or blank."""
    for column in columns:
        df = df.filter(~is_blank(F.col(column)))
    return df


def _exploded(profiles: DataFrame, tags: Column, keep: Sequence[str]) -> DataFrame:
    """(kept columns, tag as written, cleaned industry): an industry is cleaned once, before the tags unfold."""
    people = profiles.filter(has_tag(F.col("industry"))).select(
        *keep, clean_tag(F.col("industry")).alias("industry"), tags.alias("_tags")
    )
    written = people.select(*keep, F.explode("_tags").alias("tag"), "industry")
    return written.filter(has_tag(F.col("tag")))


def explode_skill_tags(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(tag, industry), both cleaned, for each skill of each profile."""
    return _exploded(profiles, F.col("skills"), keep).withColumn("tag", clean_tag(F.col("tag")))


def explode_title_tags(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(tag, industry), both cleaned, for each position title of each profile."""
    titles = F.col("positions")["title"]
    return _exploded(profiles, titles, keep).withColumn("tag", clean_tag(F.col("tag")))


def distinct_skill_tags(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The distinct rows of :func:`explode_skill_tags`.

    Skills are made distinct as written, map side included, and cleaned after that: once per batch and
    industry, and not for each person who has them.
    """
    written = _exploded(profiles, F.col("skills"), keep)
    counted = written.groupBy(*keep, "tag", "industry").agg(F.count("*").alias("_skills"))
    # The count is never 0. Asking for it keeps Spark from merging this step into the one below, which
    # would clean each skill again.
    once = counted.filter("_skills > 0").select(*keep, clean_tag(F.col("tag")).alias("tag"), "industry")
    return once.distinct()


def tag_industries(tags: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(tag, industries): the distinct industries of each tag, in ascending order.

    ``keep`` names batch columns, for one row per batch and tag. The pairs are
    made distinct first, map side included, so a tag that a third of all rows
    carry reaches the last step only once per industry.
    """
    return (
        tags.select(*keep, "tag", "industry")
        .distinct()
        .groupBy(*keep, "tag")
        .agg(F.sort_array(F.collect_list("industry")).alias("industries"))
    )


def tag_row_sectors(
    rows: DataFrame,
    industry_sector: DataFrame,
    keep: Sequence[str] = (),
    normalize: bool = True,
) -> DataFrame:
    """Distinct sectors of each (tag, industries) row; ``keep`` identifies the row.

    Tags carry cleaned industries, so the lookup's keys are cleaned too unless
    ``normalize`` is off. A row whose industries are all unmapped gives nothing.
    """
    lookup = clean_lookup(industry_sector) if normalize else industry_sector
    pairs = rows.select(*keep, "tag", F.explode("industries").alias("industry"))
    return industry_sector_join(pairs, lookup).select(*keep, "tag", "sector").distinct()


def tag_sector_counts(row_sectors: DataFrame) -> DataFrame:
    """(tag, sector, n_rows): the number of rows that give a tag a sector."""
    return row_sectors.groupBy("tag", "sector").agg(F.count("*").alias("n_rows"))


def top_sector_per_tag(counts: DataFrame) -> DataFrame:
    """(tag, sector, n_rows): the sector with most rows; ties go to the first name."""
    best = F.min(F.struct((-F.col("n_rows")).alias("neg_rows"), F.col("sector")))
    return (
        counts.groupBy("tag")
        .agg(best.alias("_best"))
        .select("tag", F.col("_best.sector").alias("sector"), (-F.col("_best.neg_rows")).alias("n_rows"))
    )


def top_tags_per_sector(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """(sector, tags): the ``k`` tags with most rows, best first; ties go to the first name.

    Spark cuts each partition to its own best ``k`` per sector before it
    shuffles, so a sector's size does not matter.
    """
    order = Window.partitionBy("sector").orderBy(F.desc("n_rows"), "tag")
    ranked = counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return ranked.groupBy("sector").agg(
        F.sort_array(F.collect_list(F.struct("_rank", "tag")))["tag"].alias("tags")
    )
