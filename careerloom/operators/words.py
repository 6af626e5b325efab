"""Word frequency of text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.functions import strip_blanks


def token_frequency(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """(token, n), most frequent first: words between single spaces or line ends, trimmed."""
    words = texts.select(F.explode(F.split(F.col(text_col), "[ \\r\\n]")).alias("token"))
    counted = words.filter(F.col("token") != "").groupBy("token").agg(F.count("*").alias("n"))
    # Trimming is costly, so it is left to the distinct words; few of them merge.
    return (
        counted.select(strip_blanks(F.col("token")).alias("token"), "n")
        .filter(F.col("token") != "")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
    )


def text_lines(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per line of each text; nothing follows a final line end."""
    # A column of its own, so that each text is split once.
    split = texts.select(F.split(F.col(text_col), "\\r\\n|\\r|\\n").alias("_pieces"))
    closed = (F.element_at("_pieces", -1) == "").cast("int")
    lines = F.slice("_pieces", F.lit(1), F.size("_pieces") - closed)
    return split.select(F.explode(lines).alias("value"))


def line_count(lines: DataFrame) -> DataFrame:
    """(n_lines): the number of lines, blank ones included."""
    return lines.agg(F.count("*").alias("n_lines"))
