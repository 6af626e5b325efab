"""Whole jobs: tags to sectors, training and prediction, headcounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.operators import (
    assign_sector,
    distinct_skill_tags,
    feature_columns,
    feature_rows,
    profile_year_panel,
    require_sector,
    sector_country_active,
    sector_models,
    sector_prediction_summary,
    tag_columns,
    tag_row_sectors,
    tag_sector_counts,
    top_sector_per_tag,
    top_tags_per_sector,
    vote,
)
from careerloom.operators.model import TIE_TOLERANCE, moment_aggregates
from careerloom.schema import END_YEAR, NO, SECTORS, START_YEAR, TEST_YEAR, TOP_K
from careerloom.sources import written_table


def tag_tables(
    profiles: DataFrame,
    industry_sector: DataFrame,
    batch: Sequence[str] = ("batch",),
    k: int = TOP_K,
) -> tuple[DataFrame, DataFrame]:
    """(tag -> sector, sector -> top tags) from the profiles' skills.

    Both come from one small table of counts, which is written, so profiles are
    read once. Industry lists per tag are not built on the way: only their
    distinct (batch, tag, industry) pairs matter.
    """
    tags = distinct_skill_tags(profiles, batch)
    rows = tags.select(*batch, "tag", F.array("industry").alias("industries"))
    counts = written_table(tag_sector_counts(tag_row_sectors(rows, industry_sector, batch)))
    # One row per sector; written, so that joins see its size.
    return top_sector_per_tag(counts), written_table(top_tags_per_sector(counts, k))


def headcount_profiles(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The part of each profile that headcounts need, sector assignment included."""
    return learning_profiles(profiles, [*keep, "location"])


def learning_profiles(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The part of each profile that learning needs; of positions, only the dates.

    Narrowing first keeps the text of positions out of the scan and of all joins.
    """
    dates = F.arrays_zip(F.col("positions.start_date"), F.col("positions.end_date"))
    return profiles.select(
        "pid", *keep, "industry", "num_connections", "skills", dates.alias("positions")
    )


def evidence_table(
    assigned: DataFrame,
    top_tags: DataFrame,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    test_year: int = TEST_YEAR,
    k: int = TOP_K,
    normalize: bool = False,
    sectors: Sequence[str] = SECTORS,
) -> DataFrame:
    """Models and test data of all sectors from one pass over the :func:`learning_profiles`.

    Training rows collapse to counts and moments per (sector, year, label).
    Test rows collapse to distinct feature vectors with their number, so people
    who look alike are scored once. Partial aggregation makes both small before
    anything is shuffled. The table is written, because both halves read it.
    """
    features = feature_columns(require_sector(assigned), top_tags, k, normalize)
    panel = profile_year_panel(features, start_year, end_year, position_fields=())
    rows = feature_rows(panel, top_tags, k)
    is_test = F.col("year") == test_year
    usable = F.col("label").isNotNull() & F.col("sector").isin(list(sectors))
    vector = [
        F.when(is_test, F.col(c)).alias(f"test_{c}") for c in ("connections", "experience", *tag_columns(k))
    ]
    evidence = (
        rows.filter(is_test | usable)
        .groupBy("sector", "year", "label", *vector)
        .agg(*moment_aggregates(k))
    )
    return written_table(evidence)


def predictions_from_evidence(
    evidence: DataFrame,
    test_year: int = TEST_YEAR,
    k: int = TOP_K,
    train_before_only: bool = False,
    vocabulary_size: int = len(SECTORS),
    tie_tolerance: float = TIE_TOLERANCE,
) -> DataFrame:
    """Voted class of each distinct test vector; ``n_rows`` people share it."""
    year = F.col("year")
    trained = evidence.filter(year < test_year if train_before_only else year != test_year)
    models = written_table(sector_models(trained.withColumnRenamed("year", "model_year"), vocabulary_size))
    test = evidence.filter(year == test_year).select(
        "sector",
        "label",
        "n_rows",
        *[F.col(f"test_{c}").alias(c) for c in ("connections", "experience", *tag_columns(k))],
    )
    return vote(test, models, k, tie_tolerance)


def evaluate_held_out_year(
    profiles: DataFrame,
    industry_sector: DataFrame,
    batch: Sequence[str] = ("batch",),
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    test_year: int = TEST_YEAR,
    k: int = TOP_K,
    positive: str = NO,
    train_before_only: bool = False,
    normalize: bool = False,
    sectors: Sequence[str] = SECTORS,
    tie_tolerance: float = TIE_TOLERANCE,
) -> DataFrame:
    """Profiles to (sector, test_size, actual_left, predict_left) for the test year.

    ``normalize`` looks up cleaned industries and skills, ``sectors`` are those with models.
    """
    tag_sector, top_tags = tag_tables(profiles, industry_sector, batch, k)
    assigned = assign_sector(learning_profiles(profiles), industry_sector, tag_sector, normalize=normalize)
    evidence = evidence_table(assigned, top_tags, start_year, end_year, test_year, k, normalize, sectors)
    predictions = predictions_from_evidence(
        evidence, test_year, k, train_before_only, len(sectors), tie_tolerance
    )
    return sector_prediction_summary(predictions, positive, weight_col="n_rows")


def headcount_report(
    pruned: DataFrame,
    places: DataFrame,
    year: int,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
) -> DataFrame:
    """(sector, country, n_profiles) of the people at work in ``year``."""
    return sector_country_active(pruned, places, year, "industry", start_year, end_year)
