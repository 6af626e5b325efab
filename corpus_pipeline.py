"""A corpus made ready for training: five operators of careerloom.llm in a row.

Documents have the columns doc_id, text, lang, source and n_chars; further columns are kept, as
long as a stage returns documents. Null and empty texts have no language and go in the first stage.
Repeated rows are exact copies: one stays. Rows without a doc_id are handled like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom.llm import decontaminate, exact_dedup, language_id, minhash, packing
from careerloom.llm.common import prepare, remainder, table, written
from careerloom.llm.queries import public_tokenizer

ORACLE_SQL = None  # language identification can't be written in SQL


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: they have letters, and one language is likelier than all others together."""
    prepare(spark)
    model = language_id.fit(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    return language_id.keep_known(docs, *model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    prepare(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link, the one with the smallest doc_id."""
    prepare(spark)
    return minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark table."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    prepare(spark)
    packed = packing.pack(docs, public_tokenizer("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
