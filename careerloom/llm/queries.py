"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    exact_dedup,
    language_id,
    language_model,
    licenses,
    minhash,
    packing,
    quality,
    sharding,
    warc,
    whitening,
)
from careerloom.llm.common import prepare, remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op2_histogram_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"), 40).select(
        F.col("id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archive = warc.warc_folder(spark)
    manifest = warc.write_warc(pages, archive, range_bytes=16 << 20, roll_bytes=4 << 20)
    kind = pages.schema["page_id"].dataType
    return warc.read_warc(manifest, archive).select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op4_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    train = remainder(F.col("doc_id"), 7) != 2
    return language_model.score(table(spark, folder, "documents"), train).select(
        F.col("id").alias("doc_id"),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op5_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality.quality_scores(
        table(spark, folder, "documents"), table(spark, folder, "labels"), remainder(F.col("id"), 5) != 0
    )
    return scores.select(
        F.col("id").alias("doc_id"),
        (remainder(F.col("id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs.filter(~held_out))
    return language_id.predict(docs, *model).select(
        F.col("id").alias("doc_id"),
        (remainder(F.col("id"), 5) == 0).alias("held_out"),
        "lang_pred",
        "score",
    )


@query
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), public_tokenizer("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op12_divergence_quadtree(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


@query
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = byte_bpe.Vocabulary(spark, public_tokenizer("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, vocabulary).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
