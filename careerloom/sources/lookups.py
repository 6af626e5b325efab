"""Delimited text lines to lookup tables. The last line wins on a repeated key.

Spark rows have no order, so the line number is an input column. Lookups are
never hinted as broadcast: their files are read with known sizes, so Spark
broadcasts those below ``spark.sql.autoBroadcastJoinThreshold`` and joins
larger ones by shuffle, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom.functions import split_fields
from careerloom.sources.outputs import matching_paths


def read_lines(spark: SparkSession, path: str | list[str], line_no_col: str = "line_no") -> DataFrame:
    """Text lines with a sort key that follows the names of files, and the order of lines in each file."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return spark.read.text(path).select(place.alias(line_no_col), F.col("value").alias("line"))


def read_named_lines(spark: SparkSession, path: str, name: str, line_no_col: str = "line_no") -> DataFrame:
    """Lines of the outputs in a folder whose name contains ``name``, or else of the path itself."""
    found = matching_paths(spark, path, name)
    return read_lines(spark, found or path, line_no_col)


def _fields(lines: DataFrame, line_col: str, line_no_col: str) -> DataFrame:
    return lines.select(
        F.col(line_no_col).alias("_line_no"), split_fields(F.col(line_col)).alias("_fields")
    )


def lookup_pairs(
    lines: DataFrame,
    key: str = "key",
    value: str = "value",
    line_col: str = "line",
    line_no_col: str = "line_no",
) -> DataFrame:
    """(key, value) from the first two fields; lines with fewer fields are dropped."""
    return (
        _fields(lines, line_col, line_no_col)
        .filter(F.size("_fields") >= 2)
        .groupBy(F.col("_fields")[0].alias(key))
        .agg(F.max_by(F.col("_fields")[1], "_line_no").alias(value))
    )


def lookup_lists(
    lines: DataFrame,
    key: str = "key",
    values: str = "values",
    line_col: str = "line",
    line_no_col: str = "line_no",
) -> DataFrame:
    """(key, values): the first field, and the list of all further ones."""
    return (
        _fields(lines, line_col, line_no_col)
        .groupBy(F.col("_fields")[0].alias(key))
        .agg(F.max_by(_tail(F.col("_fields")), "_line_no").alias(values))
    )


def _tail(fields: Column) -> Column:
    return F.slice(fields, F.lit(2), F.size(fields))


def place_lookup(
    lines: DataFrame, line_col: str = "line", line_no_col: str = "line_no"
) -> DataFrame:
    """(token, country) from lines ``country,state,city``.

    Each line names its country under three tokens. Later lines override
    earlier ones, and within a line the city overrides the state, the state
    the country. Short lines and empty tokens are dropped.
    """
    return (
        _fields(lines, line_col, line_no_col)
        .filter(F.size("_fields") >= 3)
        .select(
            "_line_no",
            F.col("_fields")[0].alias("country"),
            F.posexplode(F.slice("_fields", 1, 3)).alias("_role", "token"),
        )
        .filter(F.col("token") != "")
        .groupBy("token")
        .agg(F.max_by("country", F.struct("_line_no", "_role")).alias("country"))
    )


def parse_tag_line(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``tag,industry,...`` lines to (tag, industries); other columns are kept.

    A line without a comma is its own industry list.
    """
    line = F.col(line_col)
    rest = F.when(F.contains(line, F.lit(",")), F.expr(f"substr(`{line_col}`, instr(`{line_col}`, ',') + 1)"))
    kept = [c for c in lines.columns if c != line_col]
    return lines.select(
        *kept,
        F.substring_index(line, ",", 1).alias("tag"),
        split_fields(F.coalesce(rest, line)).alias("industries"),
    )
