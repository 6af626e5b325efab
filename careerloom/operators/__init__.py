"""DataFrame operators on profiles, tags, panels, places and models."""

from careerloom.operators.model import (
    attach_top_tags,
    confusion_counts,
    feature_columns,
    feature_rows,
    label_multi_position,
    merge_models,
    score_join,
    score_nb,
    sector_models,
    sector_prediction_summary,
    split_by_year,
    tag_columns,
    train_sector_year_nb,
    vote,
)
from careerloom.operators.panel import (
    active_in_year,
    last_known_position,
    null_sector_count,
    null_sector_metrics,
    position_year_counts,
    position_years,
    profile_year_panel,
    sector_year_order,
    spans_year,
    year_store_row_count,
    year_store_rows,
)
from careerloom.operators.places import (
    location_tokens,
    resolve_country,
    sector_country_active,
    sector_country_counts,
    sector_country_span,
    sector_country_spanning,
)
from careerloom.operators.sectors import (
    assign_sector,
    clean_lookup,
    dominant_skill_sector,
    industry_sector_join,
    prune_profile,
    require_sector,
    skill_sector_join,
    valid_sector,
)
from careerloom.operators.tags import (
    distinct_skill_tags,
    drop_blank,
    explode_skill_tags,
    explode_title_tags,
    tag_industries,
    tag_row_sectors,
    tag_sector_counts,
    top_sector_per_tag,
    top_tags_per_sector,
)
from careerloom.operators.words import line_count, text_lines, token_frequency

__all__ = [
    "active_in_year",
    "assign_sector",
    "attach_top_tags",
    "clean_lookup",
    "confusion_counts",
    "distinct_skill_tags",
    "dominant_skill_sector",
    "drop_blank",
    "explode_skill_tags",
    "explode_title_tags",
    "feature_columns",
    "feature_rows",
    "industry_sector_join",
    "label_multi_position",
    "last_known_position",
    "line_count",
    "merge_models",
    "location_tokens",
    "null_sector_count",
    "null_sector_metrics",
    "position_year_counts",
    "position_years",
    "profile_year_panel",
    "prune_profile",
    "require_sector",
    "resolve_country",
    "score_join",
    "score_nb",
    "sector_country_active",
    "sector_country_counts",
    "sector_country_span",
    "sector_country_spanning",
    "sector_models",
    "sector_prediction_summary",
    "sector_year_order",
    "skill_sector_join",
    "spans_year",
    "split_by_year",
    "tag_columns",
    "tag_industries",
    "tag_row_sectors",
    "tag_sector_counts",
    "text_lines",
    "token_frequency",
    "top_sector_per_tag",
    "top_tags_per_sector",
    "train_sector_year_nb",
    "valid_sector",
    "vote",
    "year_store_row_count",
    "year_store_rows",
]
