"""Exact deduplication as a stream with keyed state on disk.

Each row's digest is a key of a stateful streaming aggregation. The state lives
in RocksDB, never expires, and holds for a digest the number of rows, the
identifier that stays (the largest) and the place of its content (file and row).
A digest seen more than once is a hit; the texts of hits are compared byte by
byte with the content at the kept place, and digests whose texts differ are
split by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import ascii_lower, located, shared_folder, stored, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a micro-batch are bounded by the bytes of the files that it takes up.
BATCH_BYTES = 4 << 30


def normal_text(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def by_digest(entries: DataFrame) -> DataFrame:
    return entries.groupBy("digest").agg(
        F.count("*").alias("group_size"), F.max(F.struct("id", "at_file", "at_row")).alias("keep")
    )


def digest_state(entries: DataFrame, path: str, checkpoint: str | None = None) -> DataFrame:
    """Stream entries (digest, id, at_file, at_row) stored at path through keyed state; return the state.

    Columns: digest, group_size, keep (id, at_file, at_row). With the checkpoint folder of an earlier
    run, the stream takes up only files that are new at path and adds to the state it has.
    """
    spark = entries.sparkSession
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "128")
    # Stores of a finished stream give their memory back soon.
    session.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
    # Many small stores would each claim megabytes of disk ahead of need.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    stream = session.readStream.schema(entries.schema).option("maxBytesPerTrigger", str(BATCH_BYTES)).parquet(path)
    state = by_digest(stream)
    checkpoint = checkpoint or shared_folder(spark, "dedup-state")
    running = (
        state.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    if not running.lastProgress:  # nothing new, hence no batch
        return by_digest(entries)
    stored = session.read.format("statestore").load(checkpoint)
    count, keep = (F.col("value").getField(f.name) for f in stored.schema["value"].dataType.fields)
    stored = stored.select(F.col("key")["digest"].alias("digest"), count.alias("group_size"), keep.alias("keep"))
    groups = shared_folder(spark, "dedup-groups")
    stored.write.option("compression", "zstd").parquet(groups)
    return spark.read.schema(stored.schema).parquet(groups)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalize: Callable[[Column], Column] = normal_text,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, digest, at_file, at_row.

    Texts are equal when normalize() makes them identical. Of equal texts, the row with
    the largest id stays; of rows with that same id, the one stored last. Null texts count
    as empty; null ids sort before all others, and keep_id is null only where every id of a
    group is. Other columns aren't read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = located(docs, [F.col(id_col).alias("id"), normalize(F.col(text_col)).alias("text")])
    entries = rows.select("id", digest(F.col("text")).alias("digest"), "at_file", "at_row")
    path = shared_folder(spark, "dedup-entries")
    entries.write.option("compression", "zstd").parquet(path)
    entries = spark.read.schema(entries.schema).parquet(path)
    groups = digest_state(entries, path)

    # Full bytes of every hit against the content that is kept.
    hits = written(
        rows.withColumn("digest", digest(F.col("text"))).join(groups.filter("group_size > 1"), "digest"), "dedup-hits"
    )
    place = F.struct("id", "at_file", "at_row")
    kept = hits.filter(place == F.col("keep")).select("digest", F.col("text").alias("kept_text"))
    # Written before they are made distinct, so that Spark can split the join of a large group.
    differ = written(hits.join(kept, "digest").filter("text != kept_text").select("digest"), "dedup-differ").distinct()
    split = not differ.isEmpty()
    if split:
        groups = groups.join(differ, "digest", "left_anti")
    placed = entries.join(groups, "digest").select("id", "keep", "group_size", "digest", "at_file", "at_row")
    if split:
        apart = hits.join(differ, "digest", "left_semi").drop("keep", "group_size")
        groups = apart.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max(place).alias("keep"))
        placed = placed.unionByName(apart.join(groups, ["digest", "text"]).select(*placed.columns))
    return placed.select(
        "id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (place == F.col("keep")).alias("kept"),
        "digest",
        "at_file",
        "at_row",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that exact_dedup keeps, with all their columns."""
    docs = stored(docs)
    dropped = exact_dedup(docs, id_col, text_col).filter(~F.col("kept"))
    place = ["__at_file", "__at_row"]
    dropped = written(dropped.select(*(F.col(c[2:]).alias(c) for c in place)), "dedup-dropped")
    return located(docs, [F.col(f"`{c}`") for c in docs.columns], *place).join(dropped, place, "left_anti").drop(*place)
