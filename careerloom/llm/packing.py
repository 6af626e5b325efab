"""Best-fit packing of tokenized documents into sequences of a fixed length.

Documents become pieces of at most `capacity` tokens. Pieces are dealt out to packers of a
bounded number of pieces; each packer keeps a fixed number of open bins, found through a
bitset keyed by free space. A piece goes into the bin with the least sufficient space; when no bin
has room and all are open, the fullest closes first.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import written

CAPACITY = 1024
OPEN_BINS = 1 << 12
END_ID = 2
#: Pieces that one packer takes up, about.
PACKER_PIECES = 1 << 17
#: A task remembers the ids of the pre-tokens it met last, of so many at least and twice as many at most.
MEMORY = 250_000
#: Longer pre-tokens aren't remembered, so the memory is bounded in bytes too.
LONGEST = 64

#: Characters for which the pattern below splits a text as the tokenizer does: ASCII but for the
#: separators 0x1C-0x1F, and Latin letters. Other texts are given to the tokenizer whole.
PLAIN = re.compile(r"[^\x00-\x1b\x20-\x7f¡-±´-¸º»¿-ʯ‐-‧€]")
#: The letters among them; the digits are 0 to 9. Ranges are much faster than classes such as \w.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ʯ"
SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]++| ?[0-9]++| ?[^\s0-9{LETTERS}]++|\s+(?!\S)|\s+")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level BPE writes each byte: itself where it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    unseen = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(unseen)}


class Known(dict):
    """The ids of pre-tokens, by byte-level BPE; unknown ones are given to the tokenizer's model.

    When MEMORY are known they become those known before, and only those that are used again come back: what
    is frequent is never forgotten, however many rare ones there are.
    """

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.letters, self.before = model.tokenize, byte_letters(), {}

    def encode(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():  # all bytes but the space are their own letters
            letters = part.replace(" ", self.letters[0x20])
        else:
            letters = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            ids = self.encode(part)
        if len(part) <= LONGEST:
            if len(self) >= MEMORY:
                self.before = self.copy()
                self.clear()
            self[part] = ids
        return ids


@lru_cache(maxsize=1)
def loaded(path: str):
    """The tokenizer of a file; a Python worker reads it for its first task only."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    Byte-level BPE encodes the pre-tokens of a text apart, so the ids of each are remembered. Texts
    that the pattern here might split in another way are given to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = loaded(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(self.tokenizer.model)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if PLAIN.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, SPLIT.findall(text)))


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of count tokens; the first may be shorter than the others, which are full."""
    first = count % capacity or min(count, capacity)
    return [(0, first), *((at, capacity) for at in range(first, count, capacity))]


class BestFit:
    """Bounded-space online best fit. place(length) gives (bin, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.with_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.bins = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = self.take(space)
        else:
            if self.open == self.limit:
                self.take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            chosen, space = self.bins, self.capacity
            self.bins += 1
        if space > length:
            self.with_space[space - length].append(chosen)
            self.bits |= 1 << (space - length)
            self.open += 1
        return chosen, self.capacity - space

    def take(self, space: int) -> int:
        chosen = self.with_space[space].pop()
        if not self.with_space[space]:
            self.bits &= ~(1 << space)
        self.open -= 1
        return chosen


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    ids: bool = False,
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32), with ids=True also the token ids as bytes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column("text")):
                code = encoder(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(len(code) // 4, capacity)):
                    part = code[4 * start : 4 * (start + length)]
                    at.append(i)
                    rows.append((k, start, length, zlib.crc32(part), *([part] if ids else [])))
            columns = list(zip(*rows, strict=True)) or [[]] * (4 + ids)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64()))]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)],
                names=["id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")
    return rows.mapInArrow(encode, schema)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS, ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document is its token ids and END_ID; null and empty texts are END_ID alone. Only documents
    longer than capacity are cut. Pieces of full length are sequences of their own. Repeated rows
    and rows without an id are packed like any others; other columns aren't read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    table = written(pieces(docs, tokenizer, id_col, text_col, capacity, ids), "pieces")
    packers = max(1, round(table.count() / PACKER_PIECES))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer = BestFit(capacity, open_bins)
        for batch in batches:
            # Of the pieces at hand, long ones come first: they leave the gaps that short ones fill.
            lengths = batch.column("length").to_numpy()
            placed = {i: packer.place(int(lengths[i])) for i in np.argsort(-lengths, kind="stable").tolist()}
            placed = [placed[i] for i in range(len(lengths))]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + b for b, _ in placed], pa.int64()),
                    pa.array([at for _, at in placed], pa.int64()),
                ],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    # A mixture of lengths: with few open bins, if all long pieces came first, their gaps would close before short ones come.
    order = [F.xxhash64("id", "piece", "ids_crc32", "start")]
    dealt = table.repartition(packers, F.col("id"), F.col("piece"), F.col("ids_crc32")).sortWithinPartitions(*order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return dealt.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")
