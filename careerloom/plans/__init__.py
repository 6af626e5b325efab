"""The operators put together: whole jobs, and profiles derived from tables."""

from careerloom.plans.files import (
    data_model_files,
    headcount_files,
    predictor_files,
    tag_industry_files,
    tag_sector_files,
    word_count_files,
    year_store_files,
    year_store_headcount_files,
)
from careerloom.plans.jobs import (
    evaluate_held_out_year,
    evidence_table,
    headcount_report,
    learning_profiles,
    predictions_from_evidence,
    tag_tables,
)

__all__ = [
    "data_model_files",
    "evaluate_held_out_year",
    "evidence_table",
    "headcount_files",
    "headcount_report",
    "learning_profiles",
    "predictions_from_evidence",
    "predictor_files",
    "tag_industry_files",
    "tag_sector_files",
    "tag_tables",
    "word_count_files",
    "year_store_files",
    "year_store_headcount_files",
]
