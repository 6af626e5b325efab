"""Benchmark decontamination: size-partitioned MinHash containment search, natively in Spark.

An item is contained in a document that holds at least CONTAINMENT percent of the item's
shingles. The items are partitioned by size (powers of two); the sketch of an item holds
its smallest shingle hashes, as many as an item of the largest size in its partition may miss, and
one more. A document that contains the item therefore has at least one shingle of the sketch, however
long the document and wherever the shingles are: the search loses nothing, and needs no
sketch of the document. Candidates are verified on the exact shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import hashed, joined, located, shingles, stored, without, words, written

WIDTH = 5
#: Percent of an item's shingles that a document holds at least.
CONTAINMENT = 80


def item_table(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Rows (item_id, width, shingles, n, minima). Shorter items are one shingle of their own width; blank ones go."""
    rows = items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("words")).filter(
        F.size("words") > 0
    )
    rows = rows.select(
        "item_id",
        F.least(F.size("words"), F.lit(width)).alias("width"),
        F.array_distinct(shingles(F.col("words"), width, joined)).alias("shingles"),
        F.array_distinct(shingles(F.col("words"), width, hashed)).alias("hashes"),
    ).withColumn("n", F.size("shingles"))
    largest = F.expr("(1 << length(bin(n))) - 1")
    needed = F.expr(f"({CONTAINMENT} * largest + 99) div 100")
    return (
        rows.withColumn("largest", largest)
        .withColumn("minima", F.slice(F.array_sort("hashes"), F.lit(1), (F.col("largest") - needed + 1).cast("int")))
        .select("item_id", "width", "shingles", "n", "minima")
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    width: int = WIDTH,
) -> DataFrame:
    """One row per document and contained item: id, item_id, n_shared, n_item, containment.

    Words are runs of other characters than white space, A-Z in lower case. Shingles are
    distinct runs of `width` words; an item with fewer words is one shingle, looked for as a run of as many words.
    Null and blank texts contain nothing and are contained nowhere. Rows with equal ids count as one
    document that holds what any one of its rows contains; null ids are such an id. Other columns aren't read.
    """
    texts = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("words"))
    exact = confirmed(texts, items, ["id"], item_col, width)
    if exact is None:
        return no_pairs(docs, items.select(F.col(item_col).alias("item_id")), id_col)
    return (
        exact.groupBy("id", "item_id", "n_item")
        .agg(F.max("n_shared").alias("n_shared"))
        .select("id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def confirmed(texts: DataFrame, items: DataFrame, columns: list[str], item_col: str, width: int) -> DataFrame | None:
    """For texts (id, words, others): rows of the columns, item_id, n_shared, n_item; None if no item has a word.

    Each row that has the id of a candidate is verified on its own words.
    """
    items = written(item_table(items, item_col, "text", width), "bench-items")
    sketch = written(
        items.select("item_id", "width", F.explode("minima").alias("hash")).distinct(), "bench-sketch"
    )
    # At most `width` numbers.
    widths = [r["width"] for r in items.select("width").distinct().collect()]
    if not widths:
        return None

    seen = None
    for w in widths:
        own = texts.filter(F.size("words") >= w).select(
            "id", F.lit(w).alias("width"), F.explode(shingles(F.col("words"), w, hashed)).alias("hash")
        )
        seen = own if seen is None else seen.unionByName(own)
    candidates = written(seen.join(sketch, ["width", "hash"]).select("id", "item_id").distinct(), "bench-candidates")

    found = candidates.join(items, candidates["item_id"].eqNullSafe(items["item_id"])).select(
        F.col("id").alias("found_id"), items["item_id"], "width", "shingles", "n"
    )
    pairs = texts.join(found, F.col("id").eqNullSafe(F.col("found_id")))
    exact = None
    for w in widths:
        own = pairs.filter(F.col("width") == w).select(
            *columns,
            "item_id",
            F.size(F.array_intersect("shingles", shingles(F.col("words"), w, joined))).cast("bigint").alias("n_shared"),
            F.col("n").cast("bigint").alias("n_item"),
        )
        exact = own if exact is None else exact.unionByName(own)
    return exact.filter(F.expr(f"100 * n_shared >= {CONTAINMENT} * n_item"))


def no_pairs(docs: DataFrame, items: DataFrame, id_col: str) -> DataFrame:
    document, item = (t.schema[c].dataType.simpleString() for t, c in ((docs, id_col), (items, "item_id")))
    return docs.sparkSession.createDataFrame(
        [], f"id {document}, item_id {item}, n_shared bigint, n_item bigint, containment double"
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that contain no item, with all their columns. Each row is judged by its own text, whatever its id."""
    docs, place = stored(docs), ["at_file", "at_row"]
    rows = located(docs, [words(F.col(text_col)).alias("words")])
    # Shingles carry a hash of the place; rows that share one are verified apart.
    exact = confirmed(rows.withColumn("id", F.xxhash64(*place)), items, place, "item_id", WIDTH)
    return docs if exact is None else without(docs, written(exact.select(*place).distinct(), "bench-found"))
