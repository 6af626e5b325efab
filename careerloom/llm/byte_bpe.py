"""Byte-level BPE over whole corpora: every distinct pre-token is encoded once.

Texts are cut into pre-tokens. Those of a block of documents are exploded as its distinct words, each with its number
in the block; their positions in the texts stay with the block as a sequence of these numbers. A global shuffle
brings equal words of all blocks to one bucket, where each is encoded once and its ids are joined to all blocks that
have it. Back at the block, ids are put together by position. Decoding joins ids with the table of the
tokens' bytes, of as many rows as the vocabulary.

A block sends one row to each bucket for which it has words, so there are never more rows than words.
"""

from __future__ import annotations

import base64
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careerloom.llm.common import stored

#: Characters of text in a block, about; and bytes of text for each bucket of words.
BLOCK_CHARS = 8 << 20
BUCKET_BYTES = 24 << 20
#: Texts are cut into pre-tokens in parts of so many characters, about.
PART = 1 << 20
#: A vocabulary of more bytes isn't broadcast.
MAX_VOCABULARY = 64 << 20


def has_unassigned(text: str) -> bool:
    """Whether the text has characters that Unicode had not assigned when this Python was made.

    Libraries with other tables may or may not take them for letters, so only the tokenizer itself splits texts that have them.
    """
    return any(unicodedata.category(c) == "Cn" for c in set(text))


def parts(text: str) -> Iterator[str]:
    """The text in parts of about PART characters. White space after something else always begins a pre-token."""
    gap, at = re.compile(r"(?<=\S)(?=[ \n])"), 0
    while len(text) - at > PART:
        found = gap.search(text, at + PART)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class Splitter:
    """Pre-tokens as numbers, by first occurrence. They are matches of the pattern, or a part of a text that only the tokenizer can split."""

    def __init__(self, pattern: str):
        import regex

        self.find, self.words = regex.compile(pattern).findall, {}

    def __call__(self, text: str) -> np.ndarray:
        words, found = self.words, []
        for part in parts(text):
            odd = not part.isascii() and has_unassigned(part)
            numbers = [words.setdefault(w, len(words)) for w in ([part] if odd else self.find(part))]
            found.append(np.array(numbers, np.int32))
        return np.concatenate(found)


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, count: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data, decompressed_size=count * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(size, count).T.copy().view(kind).ravel()


def pre_tokens(docs: DataFrame, pattern: str, buckets: int, block_chars: int) -> DataFrame:
    """Rows of blocks, and rows of words for the buckets; `dealt` is a block, or -1 - bucket.

    A block has the ids of its documents, the lengths and the word numbers of their texts. A row of words has their
    number, the words one after the other with their lengths, and their numbers in the block.
    """
    kind = docs.schema["id"].dataType
    texts = [
        T.StructField("ids", T.ArrayType(kind)),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("numbers", T.BinaryType()),
    ]
    words = [T.StructField("words", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in ("joined", "widths", "nos"))]
    schema = T.StructType([T.StructField("dealt", T.LongType()), T.StructField("block", T.LongType()), *texts, *words])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        split, ids, numbers, size = Splitter(pattern), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            flat, held = np.concatenate(numbers), pa.concat_arrays(ids)
            kinds = [pa.int64(), pa.int64(), pa.list_(held.type), pa.list_(pa.int32()), pa.binary()]
            kinds += [pa.int32(), pa.binary(), pa.binary(), pa.binary()]

            def row(dealt: int, **columns) -> pa.RecordBatch:
                columns |= {"dealt": pa.array([dealt], pa.int64()), "block": pa.array([block], pa.int64())}
                found = [columns.get(c, pa.nulls(1, t)) for c, t in zip(schema.names, kinds, strict=True)]
                return pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array([x], t) for x, t in zip(found, kinds, strict=True)],
                    names=schema.names,
                )

            own = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
            yield row(block, ids=own, lengths=[len(n) for n in numbers], numbers=packed(flat))
            found = [w.encode() for w in split.words]
            bucket = np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % buckets
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            names, first = np.unique(bucket[order], return_index=True)
            for name, nos in zip(names.tolist(), np.split(order, first[1:]), strict=True):
                some = [found[i] for i in nos.tolist()]
                yield row(
                    -1 - name,
                    words=len(some),
                    joined=pa.compress(b"".join(some), codec="zstd", asbytes=True),
                    widths=packed(np.fromiter(map(len, some), np.int32, len(some))),
                    nos=packed(nos),
                )

        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                numbers.append(split(text))
                ids.append(batch.column("id").slice(i, 1))
                size += len(text)
                if size >= block_chars:
                    yield from flush()
                    split, ids, numbers, size, block = Splitter(pattern), [], [], 0, block + 1
        if ids:
            yield from flush()

    return docs.mapInArrow(make, schema)


class Vocabulary:
    """Byte strings and their ranks, from a file of lines `base64 rank`. It is small, which is checked, and broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        if Path(path).stat().st_size > MAX_VOCABULARY:
            raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.shared = spark.sparkContext.broadcast(ranks)

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        return self.shared.value

    def __getstate__(self):
        return {"shared": self.shared}

    def encoding(self, pattern: str):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens one after the other; start and length of each id, -1 for ids that are none."""
        size = max(self.ranks.values(), default=-1) + 1
        starts, lengths = np.zeros(size, np.int64), np.full(size, -1)
        flat = b"".join(self.ranks)
        ids = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        lengths[ids] = own = np.fromiter(map(len, self.ranks), np.int64, len(self.ranks))
        starts[ids] = np.cumsum(own) - own
        return np.frombuffer(flat, np.uint8), starts, lengths


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + length], one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + len(flat) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    places += np.arange(total, dtype=kind)
    return flat[places]


ANSWER = "block bigint, words int, tokens int, nos binary, counts binary, ids binary"
ANSWER_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def encode_words(vocabulary: Vocabulary, pattern: str):
    """Of the rows of words that blocks sent to a bucket: each distinct word encoded once, and its ids for each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, places, codes = None, {}, []
        for batch in batches:
            for row in batch.select(["block", "words", "joined", "widths", "nos"]).to_pylist():
                if row["words"] is None:
                    continue
                encoding = encoding or vocabulary.encoding(pattern)
                widths = unpacked(row["widths"], row["words"], np.int32)
                ends = np.cumsum(widths, dtype=np.int64)
                joined = pa.decompress(row["joined"], decompressed_size=int(ends[-1]), codec="zstd", asbytes=True)
                own = []
                for end, width in zip(ends.tolist(), widths.tolist(), strict=True):
                    word = joined[end - width : end]
                    place = places.get(word)
                    if place is None:
                        place = places[word] = len(codes)
                        # A part that only the tokenizer can split is split by it; it leaves all other words whole.
                        codes.append(encoding.encode_ordinary(word.decode()))
                    own.append(codes[place])
                counts = np.fromiter(map(len, own), np.int32, len(own))
                ids = np.fromiter(chain.from_iterable(own), np.uint32)
                answer = (row["block"], len(own), len(ids), row["nos"], packed(counts), packed(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(answer, ANSWER_TYPES, strict=True)],
                    names=["block", "words", "tokens", "nos", "counts", "ids"],
                )

    return encode


def reassemble(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The ids of the documents of a block: those of its words, by position. Rows of words are left out."""
    texts = texts.filter(pc.is_valid(texts.column("numbers")))
    lengths = texts.column("lengths").combine_chunks().flatten().to_numpy().astype(np.int64)
    ids = texts.column("ids").combine_chunks().flatten()
    numbers = [unpacked(n.as_py(), int(lengths.sum()), np.int32) for n in texts.column("numbers")]
    numbers = numbers[0] if numbers else np.zeros(0, np.int32)
    rows = answers.to_pylist()
    columns = [
        np.concatenate([np.zeros(0, kind), *(unpacked(r[name], r[size], kind) for r in rows)])
        for name, size, kind in (("nos", "words", np.int32), ("counts", "words", np.int32), ("ids", "tokens", np.uint32))
    ]
    nos, counts, flat = columns
    starts, widths = np.zeros(len(nos), np.int64), np.zeros(len(nos), np.int64)
    widths[nos] = counts
    starts[nos] = np.cumsum(counts, dtype=np.int64) - counts
    tokens = gathered(flat, starts[numbers], widths[numbers]).astype(np.int32)
    ends = np.append(0, np.cumsum(widths[numbers]))[np.append(0, np.cumsum(lengths))]
    return pa.table(
        {"id": ids, "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))}
    )


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per document: id, ids (array of int), without special tokens.

    Null and empty texts have no ids. Texts are never normalised, and strings that look like special tokens are ordinary
    text. Repeated rows and rows without an id are encoded like all others; an empty table gives no rows, and
    other columns aren't read. A text is whole in one block, so a block is as long as its longest text at least.
    """
    # Blocks are runs of rows of files, so a task that runs again makes the same ones.
    rows = stored(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = -(-size // bucket_bytes) + 1
    parts = int(buckets + size // block_chars + 1)
    # Both groupings below need the rows as they are dealt out here, so there is one exchange of them.
    dealt = pre_tokens(rows, pattern, buckets, block_chars).repartition(parts, "dealt")
    answers = dealt.groupBy("dealt").applyInArrow(encode_words(vocabulary, pattern), ANSWER)
    kind = rows.schema["id"].dataType.simpleString()
    return dealt.groupBy("dealt").cogroup(answers.groupBy("block")).applyInArrow(
        reassemble, f"id {kind}, ids array<int>"
    )


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """The rows with the bytes of their ids. Ids null, or with an entry that is null or no token, have bytes null.

    The table of the tokens' bytes is joined where the ids are, in their order: it has a row for each token of the vocabulary,
    whatever the size of the corpus, so it is broadcast and nothing has to be put in order again.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField(bytes_col, T.BinaryType())])

    def run(ids: pa.Array) -> bytes | None:
        flat, starts, lengths = vocabulary.table
        out = []
        for at in range(0, len(ids), PART):
            some = ids.slice(at, PART)
            if some.null_count:
                return None
            some = some.to_numpy()
            if len(some) and (some.min() < 0 or some.max() >= len(lengths) or lengths[some].min() < 0):
                return None
            out.append(gathered(flat, starts[some], lengths[some]).tobytes())
        return b"".join(out)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [run(ids.values) if ids.is_valid else None for ids in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=schema.names)

    return encoded.mapInArrow(join, schema)
