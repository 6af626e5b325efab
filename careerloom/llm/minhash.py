"""Near-duplicate groups: universal hash minima, banding, verification, connected components.

Documents are sets of word shingles. Equal word sequences form one node. Each node has
HASHES minima under multiply-shift hash functions; nodes that agree in all minima of a
band share a bucket. At a similarity of 0.8, two nodes share none of the BANDS buckets with
a probability of (1 - 0.8**ROWS)**BANDS = 5e-8. Links are confirmed on whole shingle sets.

Pairs of a bucket are never listed. Its members are first compared with one leader; once the
confirmed links are joined to components, only buckets that still hold several
components go on, in blocks of bounded size, and of those only members that have a partner in another
component whose signature agrees often enough. Such members meet with their
shingle sets, the likeliest pairs are verified first, and only the links that join
two components leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import located, stored, without, word_hashes, written
from careerloom.llm.components import connected_components

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
WIDTH = 4
#: Percent of the union that the intersection of two linked documents holds at least.
SIMILARITY = 80
#: Minima in which two linked nodes agree at least: four standard deviations below 80 percent.
AGREEMENT = 84
#: The stored place of a row, as `located` names it.
PLACE = ["at_file", "at_row"]
#: A bucket of more members is compared in blocks of about this many.
BLOCK = 1024

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(word: np.ndarray, width: int) -> np.ndarray:
    """Distinct 64-bit hashes of the runs of width words; a shorter text is one run."""
    size = min(width, len(word))
    runs = np.full(len(word) - size + 1, size, np.uint64)
    for k in range(size):
        runs = (runs ^ word[k : len(word) - size + 1 + k]) * MIX
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def minima(runs: np.ndarray) -> np.ndarray:
    """The minimum of each hash function: the upper half of a*x + b for the 32-bit x of a shingle."""
    x = runs >> np.uint64(32)
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    buffer = np.empty((HASHES, min(len(x), 1024)), np.uint64)
    for at in range(0, len(x), 1024):
        part = x[at : at + 1024]
        out = buffer[:, : len(part)]
        np.multiply(FACTORS[:, None], part[None, :], out=out)
        np.add(out, ADDENDS[:, None], out=out)
        np.minimum(least, out.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit bucket for each signature (row) and band."""
    lanes = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), lanes.shape[:2]).copy()
    for k in range(ROWS):
        out = (out ^ lanes[:, :, k]) * MIX
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def runs_of_rows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[bytes, np.ndarray | None]]:
    """Of each row of a batch with word hashes: a key of the word sequence, and the shingle hashes (None without words)."""
    lists = batch.column("hashes")
    ends = lists.offsets.to_numpy().tolist()
    flat = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    for start, end in zip(ends, ends[1:], strict=False):
        word = flat[start:end]
        yield hashlib.md5(word.tobytes()).digest(), shingle_hashes(word, width) if len(word) else None


def signer(width: int):
    """Marks of rows with word hashes; other columns are passed on."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], np.zeros(len(batch), np.int64)
            signatures = np.zeros((len(batch), HASHES), np.uint32)
            for i, (key, runs) in enumerate(runs_of_rows(batch, width)):
                keys.append(key)
                if runs is not None:
                    sizes[i], signatures[i] = len(runs), minima(runs)
            others = [c for c in batch.schema.names if c != "hashes"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in others),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes),
                    pa.array([r.tobytes() for r in signatures.astype(np.uint8)], pa.binary()),
                    pa.FixedSizeListArray.from_arrays(pa.array(band_hashes(signatures).ravel()), BANDS).cast(
                        pa.list_(pa.int64())
                    ),
                ],
                names=[*others, "key", "n_shingles", "signature", "bands"],
            )

    return sign


def set_maker(width: int):
    """(node, shingles) of rows (node, hashes)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [runs.view(np.int64) for _, runs in runs_of_rows(batch, width)]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate(sets) if sets else np.array([], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["node", "shingles"],
            )

    return make


def agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough."""
    for batch in batches:
        if len(batch) == 0:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES)
            for c in ("signature_a", "signature_b")
        )
        yield batch.select(["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= AGREEMENT))


class Group:
    """The members of one bucket, or of two of its blocks: pairs of different components that may be linked."""

    def __init__(self, table: pa.Table):
        self.node, self.part, self.side, self.size = (
            table.column(c).to_numpy() for c in ("node", "component", "side", "n_shingles")
        )
        self.signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
        self.bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        self.bucket = table.column("bucket")[0].as_py()
        self.split, self.place = self.side.max() > 0, np.arange(len(self.node))

    def partners(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Members to be compared with i, with the number of minima that agree. Pairs are left to the first bucket they share."""
        j = np.flatnonzero(
            (self.part != self.part[i])
            & ((self.side > self.side[i]) if self.split else (self.place > i))
            & (100 * np.minimum(self.size, self.size[i]) >= SIMILARITY * np.maximum(self.size, self.size[i]))
        )
        j = j[self.bands[i, (self.bands[j] == self.bands[i]).argmax(axis=1)] == self.bucket]
        same = (self.signature[j] == self.signature[i]).sum(axis=1)
        return j[same >= AGREEMENT], same[same >= AGREEMENT]


def open_members(table: pa.Table) -> pa.Table:
    """The members of a group that have a partner in it."""
    group = Group(table)
    some = np.zeros(len(group.node), bool)
    for i in range(len(group.node)):
        j, _ = group.partners(i)
        some[j] = True
        some[i] |= len(j) > 0
    return table.select(["bucket", "low", "high", "side", "node"]).filter(pa.array(some))


def group_links(table: pa.Table) -> pa.Table:
    """Confirmed links that join the components of a group, by exact similarity of whole shingle sets."""
    group = Group(table)
    lists = table.column("shingles").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    pairs = []
    for i in range(len(group.node)):
        j, same = group.partners(i)
        pairs.append(np.stack([np.full(len(j), i), j, same]).astype(np.int32))
    pairs = np.concatenate(pairs, axis=1)
    pairs = pairs[:2, np.lexsort((pairs[1], pairs[0], -pairs[2]))]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x] = root.get(root[x], root[x])
        return x

    a, b = [], []
    for i, j in pairs.T:  # the likeliest first; what is joined already needs no further link
        low, high = sorted((find(int(group.part[i])), find(int(group.part[j]))))
        if low == high:
            continue
        x, y = flat[ends[i] : ends[i + 1]], flat[ends[j] : ends[j + 1]]
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= SIMILARITY * (len(x) + len(y) - both):
            root[high] = low
            a.append(int(group.node[i]))
            b.append(int(group.node[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: the exact similarity of their whole shingle sets."""
    a, b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"shingles_{c}")) for c in "ab")
    both = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - both
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= SIMILARITY * union).select("a", "b")


def several(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (bucket, node, component, members) of the buckets that hold more than one component."""
    rows = buckets.select("bucket", "node").join(parts, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    open_ = rows.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")
    )
    return rows.join(open_.filter("low < high").select("bucket", "members"), "bucket")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= 80 * |union| of their sets of
    distinct shingles of A-Z-lowered words; a text of fewer words is one shingle. Texts that
    are null, empty or blank have no shingle and no link. component_id is the
    smallest id that links reach; null ids are never the smallest, and a component of only null ids
    has a null component_id. kept is id = component_id, so repeated rows are all kept, and rows
    without an id are kept only in components without any id. Other columns aren't read.
    """
    docs = stored(docs)
    rows = located(docs, [F.col(id_col).alias("id"), word_hashes(F.col(text_col)).alias("hashes")])
    marks, owners = components(docs, rows, text_col, width)
    smallest = owners.groupBy("component").agg(F.min("id").alias("component_id"))
    owners = written(owners.join(smallest, "component").select("key", "component_id"), "near-owners")
    # A plain join of small rows: Spark splits what one component or one text has of them.
    members = marks.select("id", "key", "n_shingles").join(owners, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return members.select(
        "id", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def components(
    docs: DataFrame, rows: DataFrame, text_col: str, width: int
) -> tuple[DataFrame, DataFrame]:
    """Marks of located rows (id, hashes, place), and nodes with key, id, component and the `first` of their marks.

    `first` is the mark with the smallest id (null ids last), of equal ids the one stored first. A node's text is read at its place.
    """
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "hashes"]
    marks = written(
        rows.mapInArrow(
            signer(width),
            ", ".join([*kinds, "key binary, n_shingles bigint, signature binary, bands array<bigint>"]),
        ),
        "near-marks",
    )
    nodes = written(
        marks.filter("n_shingles > 0")
        .groupBy("key")
        .agg(
            F.min("id").alias("id"),
            F.min(F.struct(F.col("id").isNull().alias("last"), "id", *PLACE)).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "near-nodes",
    )
    links = all_links(docs, nodes, text_col, width)
    owners = nodes.join(connected_components(links), "node", "left")
    return marks, owners.withColumn("component", F.coalesce("component", "node"))


def all_links(docs: DataFrame, nodes: DataFrame, text_col: str, width: int) -> DataFrame:
    """Confirmed links (a, b) between nodes; enough of them to connect all that are linked."""
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    buckets = written(banded.join(shared, "bucket"), "near-buckets")
    marks = nodes.select("node", "n_shingles", "signature", "bands")

    # Whole shingle sets of the nodes that share a bucket.
    wanted = buckets.select("node").distinct().join(nodes.select("node", "first"), "node")
    wanted = wanted.select("node", *(F.col("first")[c].alias(c) for c in PLACE))
    # Each place holds one text, so rows without an id, or with one that repeats, don't multiply.
    texts = located(docs, [F.col(text_col).alias("text")]).join(wanted, PLACE)
    texts = texts.select("node", word_hashes(F.col("text")).alias("hashes"))
    sets = written(texts.mapInArrow(set_maker(width), "node bigint, shingles array<bigint>"), "near-sets")

    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"))
    pairs = buckets.join(heads, "bucket").filter("node != head")
    pairs = pairs.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(likely(pairs, marks), sets), "near-links")

    left = several(buckets, connected_components(links)).join(marks, "node")
    left = left.withColumn("blocks", F.ceil(F.col("members") / F.lit(BLOCK)).cast("int"))
    left = left.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    # One row for each pair of blocks that the member's own block belongs to.
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [
        "bucket",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
        "node",
        "component",
        "n_shingles",
        "signature",
        "bands",
    ]
    left = written(left.select(*group), "near-open")
    key = ["bucket", "low", "high"]
    members = "bucket bigint, low int, high int, side int, node bigint"
    # Only members with a partner are brought together with their sets.
    needed = written(left.groupBy(*key).applyInArrow(open_members, members), "near-needed")
    rows = left.join(needed, [*key, "side", "node"]).join(sets, "node")
    more = rows.groupBy(*key).applyInArrow(group_links, "a bigint, b bigint")
    return links.unionByName(written(more, "near-links"))


def likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) whose set sizes and signatures allow a link."""
    a, b = (
        marks.select(
            F.col("node").alias(c), F.col("n_shingles").alias(f"size_{c}"), F.col("signature").alias(f"signature_{c}")
        )
        for c in "ab"
    )
    sized = pairs.join(a, "a").join(b, "b").filter(
        100 * F.least("size_a", "size_b") >= SIMILARITY * F.greatest("size_a", "size_b")
    )
    return sized.select("a", "b", "signature_a", "signature_b").mapInArrow(agreement, "a bigint, b bigint")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """One document of each group, with all its columns: the smallest id, null ids last; of equal ids, the one stored first.

    Texts without words are in no group and stay.
    """
    docs = stored(docs)
    rows = located(docs, [F.col(id_col).alias("id"), word_hashes(F.col(text_col)).alias("hashes")])
    marks, owners = components(docs, rows, text_col, width)
    kept = written(owners.groupBy("component").agg(F.min("first").alias("first")).select("first.*"), "near-kept")
    gone = marks.filter("n_shingles > 0").select(*PLACE).join(kept.select(*PLACE), PLACE, "left_anti")
    return without(docs, written(gone, "near-gone"))
