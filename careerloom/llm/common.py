"""What several operators of this package share: normal text, words, shared tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a run of characters other than these; the same class in Java, Python and RE2 patterns.
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null stays null."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null and blank texts have none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPACES), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingles(words_: Column, width: int, value) -> Column:
    """value(slice) of each run of width words; a shorter text is one run, one without words is null."""
    count = F.size(words_)
    starts = F.when(count >= width, F.sequence(F.lit(1), count - F.lit(width - 1))).when(
        count > 0, F.array(F.lit(1))
    )
    return F.transform(starts, lambda i: value(F.slice(words_, i, width)))


def joined(run: Column) -> Column:
    return F.array_join(run, " ")


def hashed(run: Column) -> Column:
    return F.xxhash64(run)


def remainder(id_: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo divisor; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % F.lit(divisor)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share.

    It lies in spark.checkpoint.dir, else in the session's checkpoint folder, else in the warehouse.
    """
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or (chosen.get() if chosen.isDefined() else None)
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: lineage ends here, lost executors don't matter, and Spark knows its size."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(docs: DataFrame) -> DataFrame:
    """The rows as rows of files: as they are if Spark reads them from files, else written to a shared folder."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
        return docs
    except AnalysisException:
        return written(docs, "rows")


def located(docs: DataFrame, columns: Iterable[Column], file: str = "at_file", row: str = "at_row") -> DataFrame:
    """The columns, with the file and row in which each row is stored.

    The place tells rows apart that agree in all columns.
    """
    docs = stored(docs)
    place = docs.metadataColumn("_metadata")
    return docs.select(*columns, place["file_path"].alias(file), place["row_index"].alias(row))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of stored documents whose place (at_file, at_row) isn't in gone, a written table."""
    place = ["__at_file", "__at_row"]
    gone = gone.select(*(F.col(c[2:]).alias(c) for c in place))
    return located(docs, [F.col(f"`{c}`") for c in docs.columns], *place).join(gone, place, "left_anti").drop(*place)


#: Bounds of what is in memory of a table of texts at once: rows and bytes of a batch for Python, rows of a batch read.
BOUNDS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 256,
}


def setting(value: str) -> int:
    """The number of a setting such as 1000, 4m or 64kb."""
    digits, unit = re.fullmatch(r"(-?\d+)([bkmgtp]?)b?", value.strip().lower()).groups()
    return int(digits) << 10 * "bkmgtp".find(unit or "b")


def prepare(spark: SparkSession) -> None:
    """Ready a session for long texts and for the Python workers of these operators.

    Batches get fewer rows and bytes (at Spark's defaults, a batch of long texts takes many megabytes of
    each task, in arrays that grow by doubling). The workers import this library from where the driver did, if they find it there.
    """
    for name, most in BOUNDS.items():
        if not 0 < setting(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
