"""Sharding by histogram sort.

Splitters cut the order of a key into ranges of equal bytes. In each round, exact bytes and
rows below candidate boundaries (probes) are counted over all partitions, and the interval
in which each splitter must lie shrinks, until every splitter meets the tolerance. Only then are the rows
exchanged, once. Shards are made of several ranges each, so that no task
holds a whole shard; the exact counts give each range the place of its first row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import located, written

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: Probes for each splitter and round.
PROBES = 16
#: Part of a range's bytes by which a splitter may miss its target.
TOLERANCE = 0.001
#: Bytes of one range, about: what a task sorts.
RANGE_BYTES = 256 << 20
#: Bytes that a row takes besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Ranges:
    """Splitters in order, and the exact number of rows and bytes with a smaller key than each of them."""

    splitters: np.ndarray
    rows_below: np.ndarray
    bytes_below: np.ndarray
    rows: int
    bytes: int


def below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """For each probe, the rows and bytes of smaller keys; then all rows and bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sizes = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column("key").to_numpy(), side="right")
            np.add.at(rows, at, 1)
            np.add.at(sizes, at, batch.column("size").to_numpy())
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict({"at": some, "rows": rows[some], "bytes": sizes[some]})

    counts = keys.select("key", "size").mapInArrow(count, "at bigint, rows bigint, bytes bigint")
    rows, sizes = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    # A row for each probe at most.
    for r in counts.groupBy("at").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).collect():
        rows[r["at"]], sizes[r["at"]] = r["rows"], r["bytes"]
    rows, sizes = np.cumsum(rows), np.cumsum(sizes)
    return rows[:-1], sizes[:-1], int(rows[-1]), int(sizes[-1])


def find_ranges(keys: DataFrame, ranges: int, tolerance: float = TOLERANCE) -> Ranges:
    """Splitters of the table keys (key bigint, size bigint) for so many ranges of equal bytes.

    A splitter that the tolerance can't be met for, since one key or one row is too large, is the nearest one there is.
    """
    _, _, rows, total = below(keys, np.array([], np.int64))
    targets = [total * i / ranges for i in range(1, ranges)]
    # For each splitter the interval it lies in: (key, rows below, bytes below) at both ends.
    low = [(LOWEST, 0, 0)] * len(targets)
    high = [(HIGHEST, rows, total)] * len(targets)
    done: list[tuple[int, int, int] | None] = [None] * len(targets)
    while None in done:
        probes: set[int] = set()
        for i, target in enumerate(targets):
            if done[i] is None:
                a, b = low[i][0], high[i][0]
                probes.update(a + (b - a) * k // (PROBES + 1) for k in range(1, PROBES + 1))
        order = np.array(sorted(probes), np.int64)
        counts = list(zip(order.tolist(), *(x.tolist() for x in below(keys, order)[:2]), strict=True))
        sizes = [c[2] for c in counts]
        for i, target in enumerate(targets):
            if done[i] is not None:
                continue
            at = int(np.searchsorted(sizes, target))
            if at > 0:
                low[i] = max(low[i], counts[at - 1])
            if at < len(counts):
                high[i] = min(high[i], counts[at])
            near = min(low[i], high[i], key=lambda c: abs(c[2] - target))
            # Nothing lies between the ends, or they hold one row, or the nearer one will do.
            if (
                abs(near[2] - target) <= tolerance * total / ranges
                or high[i][0] - low[i][0] <= 1
                or high[i][1] - low[i][1] <= 1
            ):
                done[i] = near
    splitters, rows_below, bytes_below = (np.array([d[k] for d in done], np.int64) for k in range(3))
    return Ranges(splitters, rows_below, bytes_below, rows, total)


def range_of(key: Column, ranges: Ranges, per_shard: int) -> Column:
    """struct(part, shard, base): the range of a key, its shard, and the rows of that shard before the range."""
    splitters = ranges.splitters
    starts = np.concatenate([[0], ranges.rows_below])
    base = starts - starts[np.arange(len(starts)) // per_shard * per_shard]

    @F.pandas_udf("part bigint, shard int, base bigint")
    def find(keys: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(splitters, keys.to_numpy(), side="right")
        return pd.DataFrame({"part": at, "shard": (at // per_shard).astype(np.int32), "base": base[at]})

    return find(key)


def shard(
    docs: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Every row with its text: id, text, size, shard, slot. Shards have nearly equal bytes.

    Size is the UTF-8 length of the text (null: 0) plus ROW_BYTES. Rows are ordered by a hash of id and row number
    in their file, so copies, long runs of one source and rows without an id spread over all shards; slot
    counts the rows of a shard from 0 in that order. Sizes differ by about one row where that is
    more than the tolerance. An empty table gives no rows; other columns aren't read.
    """
    rows = located(docs, [F.col(id_col).alias("id"), F.col(text_col).alias("text")])
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES
    rows = rows.select("id", "text", size.alias("size"), F.xxhash64("id", "at_row").alias("key"))
    keys = written(rows.select("key", "size"), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (shards * range_bytes)))
    ranges = find_ranges(keys, shards * per_shard, tolerance)
    rows = rows.withColumn("at", range_of(F.col("key"), ranges, per_shard))
    rows = rows.select("id", "text", "size", "key", "at.part", "at.shard", "at.base")
    # Ranges are bounded, and so are the windows; this is the one exchange of texts.
    place = F.expr("row_number() OVER (PARTITION BY part ORDER BY key, id, size)")
    return rows.select("id", "text", "size", "shard", (F.col("base") + place - 1).alias("slot"))
