"""The jobs from files to files. Each reads text, writes its outputs, and returns what it counted.

Inputs are paths Spark can read: files, folders or globs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom.operators import (
    assign_sector,
    confusion_counts,
    distinct_skill_tags,
    explode_title_tags,
    feature_columns,
    feature_rows,
    label_multi_position,
    line_count,
    merge_models,
    null_sector_metrics,
    position_year_counts,
    profile_year_panel,
    prune_profile,
    require_sector,
    sector_country_active,
    sector_country_span,
    sector_models,
    sector_prediction_summary,
    split_by_year,
    tag_columns,
    tag_industries,
    tag_row_sectors,
    tag_sector_counts,
    token_frequency,
    top_sector_per_tag,
    top_tags_per_sector,
    train_sector_year_nb,
    vote,
    year_store_rows,
)
from careerloom.operators.model import TIE_TOLERANCE
from careerloom.schema import END_YEAR, NO, SECTORS, START_YEAR, TEST_YEAR, TOP_K
from careerloom.sources import (
    lookup_lists,
    lookup_pairs,
    model_load,
    model_replace,
    model_store,
    observed,
    observed_row,
    parse_lines,
    parse_tag_line,
    place_lookup,
    profile_json_lines,
    profiles_of,
    read_lines,
    read_named_lines,
    rejects_of,
    with_profile_id,
    write_key_list,
    write_named_outputs,
    written_table,
    year_store_read,
    year_store_write,
)


def _parsed(
    lines: DataFrame,
    out: str,
    layout: str = "array",
    columns: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """The profiles of the lines, with a number each (pid), as a written table.

    Lines are read and parsed once; those that are dropped or read in part go next to an output, with the reason.
    """
    table = written_table(with_profile_id(parse_lines(lines, "value", layout, columns, strict)))
    rejects_of(table).write.mode("overwrite").json(f"{out}_rejected")
    return profiles_of(table)


def _write_report(report: DataFrame, path: str) -> None:
    report.select(F.concat_ws(",", *report.columns).alias("value")).write.mode("overwrite").text(path)


def tag_industry_files(
    spark: SparkSession,
    raw: str,
    out: str,
    titles: bool = False,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    strict: bool = False,
) -> DataFrame | None:
    """Raw profiles to ``tag,industry,...`` lines.

    With ``titles``, position titles count as tags too, and the number of
    positions per year is returned.
    """
    columns = ["industry", "skills", "positions"] if titles else ["industry", "skills"]
    profiles = _parsed(spark.read.text(raw), out, "array", columns, strict)
    tags = distinct_skill_tags(profiles)
    if titles:
        tags = tags.unionByName(explode_title_tags(profiles))
    write_key_list(tag_industries(tags), out, "tag", "industries")
    return position_year_counts(profiles, start_year, end_year) if titles else None


def tag_sector_files(
    spark: SparkSession, tag_lines: str, sector_csv: str, out: str, k: int = TOP_K
) -> None:
    """``tag,industry,...`` lines to ``out/tagsector`` and ``out/toptags``.

    Every line counts as one row of its tag, so several outputs of the first
    job can be read together.
    """
    rows = parse_tag_line(read_lines(spark, tag_lines))
    sectors = lookup_pairs(read_lines(spark, sector_csv), "industry", "sector")
    counts = written_table(tag_sector_counts(tag_row_sectors(rows, sectors, ["line_no"])))
    best = top_sector_per_tag(counts).select(F.concat_ws(",", "tag", "sector").alias("value"))
    tops = top_tags_per_sector(counts, k).select(F.concat_ws(",", "sector", "tags").alias("value"))
    write_named_outputs({"tagsector": best, "toptags": tops}, out)


def data_model_files(
    spark: SparkSession,
    raw: str,
    sector_csv: str,
    tag_sector: str,
    top_tags: str,
    out: str,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    test_year: int = TEST_YEAR,
    k: int = TOP_K,
    train_before_only: bool = False,
    normalize: bool = False,
    sectors: Sequence[str] = SECTORS,
    strict: bool = False,
    add_to: str | None = None,
) -> DataFrame:
    """Raw profiles to ``out/pruneddata``, ``out/testdata`` and ``out/models``.

    With ``add_to``, the folder of a model store, the profiles are a further batch of people: their counts and moments are
    added to the models there, without the earlier profiles, and ``out/models`` isn't written. The top tags must be the same.


    Returns the number of panel rows and profiles without a sector, counted while the pruned profiles were written.
    ``tag_sector`` and ``top_tags`` are read with :func:`read_named_lines`.
    """
    profiles = _parsed(spark.read.text(raw), f"{out}/raw", strict=strict).drop("relevant_experience")
    assigned = assign_sector(
        profiles,
        lookup_pairs(read_lines(spark, sector_csv), "industry", "sector"),
        lookup_pairs(read_named_lines(spark, tag_sector, "tagsector"), "tag", "sector"),
        normalize=normalize,
    )
    # Three outputs come from the assigned profiles.
    counted, missing = observed(prune_profile(assigned), **null_sector_metrics("sector", start_year, end_year))
    pruned = written_table(counted)
    known = require_sector(pruned)
    _, test = split_by_year(profile_year_panel(known, start_year, end_year), test_year)
    write_named_outputs({"pruneddata": profile_json_lines(pruned), "testdata": profile_json_lines(test)}, out)

    tags = written_table(lookup_lists(read_named_lines(spark, top_tags, "toptags"), "sector", "tags"))
    features = feature_columns(known, tags, k, normalize)
    panel = profile_year_panel(features, start_year, end_year, position_fields=())
    train, _ = split_by_year(feature_rows(panel, tags, k), test_year, train_before_only)
    models = train_sector_year_nb(train, k, sectors)
    if add_to is None:
        model_store(models, f"{out}/models")
    else:
        batch = written_table(models)
        model_replace(merge_models(model_load(spark, add_to), batch), add_to)
    return observed_row(spark, missing, "n_rows bigint, n_profiles bigint")


def predictor_files(
    spark: SparkSession,
    test_data: str,
    models: str,
    top_tags: str,
    out: str,
    k: int = TOP_K,
    positive: str = NO,
    normalize: bool = False,
    sectors: Sequence[str] = SECTORS,
    tie_tolerance: float = TIE_TOLERANCE,
    strict: bool = False,
) -> DataFrame:
    """Test data, models and top tags to ``sector,size,actual,predicted`` lines.

    Returns the confusion counts. People with equal features are scored once.
    """
    test = _parsed(spark.read.text(test_data), out, "object", strict=strict).withColumnRenamed("industry", "sector")
    tags = written_table(lookup_lists(read_named_lines(spark, top_tags, "toptags"), "sector", "tags"))
    features = label_multi_position(feature_columns(require_sector(test), tags, k, normalize))
    vector = ["connections", *tag_columns(k), "label"]
    people = features.groupBy("sector", F.col("relevant_experience").alias("experience"), *vector).agg(
        F.count("*").alias("n_rows")
    )
    by_sector = written_table(sector_models(model_load(spark, models), len(sectors)))
    predictions = written_table(vote(people, by_sector, k, tie_tolerance))
    _write_report(sector_prediction_summary(predictions, positive, "n_rows"), out)
    return confusion_counts(predictions, positive, "n_rows")


def _places(spark: SparkSession, places_csv: str) -> DataFrame:
    return place_lookup(read_lines(spark, places_csv))


def headcount_files(
    spark: SparkSession,
    pruned: str,
    places_csv: str,
    year: int,
    out: str,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    strict: bool = False,
) -> None:
    """Pruned profiles to ``sector,country,count`` lines for one year."""
    people = _parsed(spark.read.text(pruned), out, "object", ["industry", "location", "positions"], strict)
    _write_report(
        sector_country_active(people, _places(spark, places_csv), year, "industry", start_year, end_year), out
    )


def year_store_files(
    spark: SparkSession,
    pruned: str,
    store: str,
    start_year: int = START_YEAR,
    end_year: int = END_YEAR,
    load: str = "all",
    strict: bool = False,
) -> DataFrame:
    """Add pruned profiles to the year store under the name of a load; returns the number of rows, counted as they were written."""
    people = _parsed(spark.read.text(pruned), f"{store.rstrip('/')}_{load}", "object", strict=strict)
    written = year_store_write(year_store_rows(people, start_year=start_year, end_year=end_year), store, load)
    return observed_row(spark, written, "n_rows bigint")


def year_store_headcount_files(
    spark: SparkSession, store: str, places_csv: str, year: int, out: str
) -> None:
    """The year store to ``sector,country,count`` lines for one year."""
    _write_report(sector_country_span(year_store_read(spark, store), _places(spark, places_csv), year), out)


def word_count_files(spark: SparkSession, texts: str, out: str) -> DataFrame:
    """Text files to ``token : count`` lines, most frequent first; returns the number of lines read."""
    lines = spark.read.text(texts)
    words = token_frequency(lines)
    words.select(F.concat_ws(" : ", "token", "n").alias("value")).write.mode("overwrite").text(out)
    return line_count(lines)
