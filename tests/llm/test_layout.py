"""Sharding, WARC archives and packing."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from careerloom.llm import packing, sharding, warc
from careerloom.llm.common import BOUNDS, prepare, written
from careerloom.llm.queries import public_tokenizer

BPE = public_tokenizer("byte_bpe_50k.json")


def test_splitters_meet_the_tolerance(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"), (F.col("id") % 97 + 1).alias("size"))
    keys = written(keys, "t")
    ranges = sharding.find_ranges(keys, 7)
    rows = sorted((r["key"], r["size"]) for r in keys.collect())
    for splitter, n, size in zip(ranges.splitters, ranges.rows_below, ranges.bytes_below, strict=True):
        low = [s for k, s in rows if k < splitter]
        assert (len(low), sum(low)) == (n, size)
    edges = [0, *ranges.bytes_below.tolist(), ranges.bytes]
    assert max(np.diff(edges)) - min(np.diff(edges)) <= 0.003 * ranges.bytes / 7 + 97


def test_one_key_for_all_rows(spark):
    keys = written(spark.range(100).select(F.lit(5).cast("long").alias("key"), F.lit(1).cast("long").alias("size")), "t")
    assert set(sharding.find_ranges(keys, 4).rows_below.tolist()) <= {0, 100}


@pytest.mark.parametrize("range_bytes", [1 << 28, 400])
def test_shards(documents, range_bytes):
    random.seed(1)
    rows = [(i, "é" * random.randrange(200)) for i in range(900)] + [(2000, None), (2001, ""), (2000, None), (None, "x"), (None, "x")]
    got = sharding.shard(documents(*rows), 8, range_bytes=range_bytes).collect()
    assert sorted((str(r["id"]), str(r["text"])) for r in got) == sorted((str(i), str(t)) for i, t in rows)
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 for r in got)
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(8))
    sizes = [sum(r["size"] for r in s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 2 * 416
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())


def test_shards_of_nothing(documents):
    assert sharding.shard(documents((1, "a")).limit(0), 5).collect() == []


PAGES = [
    (7, "http://a/7", "same"), (3, "http://a/3", "same"), (5, None, None), (6, "http://a/6\r\nX: y", ""),
    (9, "http://a/9", "<p>\r\n\r\nÜ</p>" * 50), (11, "http://a/11", "tiny"), (12, "http://a/12", "tiny"),
    *[(100 + i, f"http://b/{i}", f"<html>{i % 3}</html>" * 40) for i in range(40)], (None, "http://n", "same"),
]


def read_back(spark, folder, rows=PAGES, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    manifest = warc.write_warc(pages, folder, **options)
    return manifest, warc.read_warc(manifest, folder).collect()


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, tmp_path, least):
    _, got = read_back(spark, str(tmp_path / "w"), range_bytes=8000, roll_bytes=700, revisit_bytes=least)
    first = {}
    for i, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(html or "", i)
    expected = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        again = len(data) >= least and first[html or ""] != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((str(i), len(data), digest, "revisit" if again else "response", str(first[html or ""]) if again else "None"))
    assert sorted((str(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == sorted(expected)
    texts = {str(i): (html or "").encode() for i, _, html in PAGES}
    assert all(r["payload"] == texts[str(r["id"])] for r in got if r["record_type"] == "response")


def test_archives_are_the_same_again(spark, tmp_path):
    files = []
    for name, rows in (("a", PAGES), ("b", PAGES[::-1])):
        manifest, _ = read_back(spark, str(tmp_path / name), rows, range_bytes=8000, roll_bytes=700)
        files.append(sorted(tuple(r) for r in manifest.collect()))
        on_disk = {p.name: p.read_bytes() for p in (tmp_path / name / "archives").glob("*.gz")}
        assert {n: hashlib.sha256(b).hexdigest() for n, b in on_disk.items()} == {f[0]: f[3] for f in files[-1]}
        assert not list((tmp_path / name / "archives").glob("*.tmp"))
    assert files[0] == files[1] and len(files[0]) > 4


def test_records_are_gzip_members(spark, tmp_path):
    manifest, _ = read_back(spark, str(tmp_path / "w"))
    assert manifest.count() == 1
    data = next((tmp_path / "w" / "archives").glob("*.gz")).read_bytes()
    text = gzip.decompress(data)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"WARC/1.1\r\n") == len(PAGES) + 1
    assert data.count(b"\x1f\x8b\x08") >= len(PAGES) + 1
    assert b"http://a/6%0D%0AX: y" in text


def test_damaged_archives_are_an_error(spark, tmp_path):
    manifest, _ = read_back(spark, str(tmp_path / "w"))
    path = next((tmp_path / "w" / "archives").glob("*.gz"))
    path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"tiny", b"tinx")))
    with pytest.raises(Exception, match="wrong block digest"):
        warc.read_warc(manifest, str(tmp_path / "w")).collect()


def test_no_pages(spark, tmp_path):
    manifest, got = read_back(spark, str(tmp_path / "w"), [])
    assert manifest.count() == 0 and got == []


ENCODER = packing.Encoder(BPE)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet=st.characters(max_codepoint=0x2FF)), st.text(alphabet=" \n\t'aAsdéß_1²½\x1c…€")))
def test_ids_are_those_of_the_tokenizer(text):
    assert ENCODER(text) == ENCODER.whole(text)


def test_ids_of_special_texts():
    for text in ("<|endoftext|>", "a<|endoftext|> b", "don't 'LL  x\n\n y ", "日本 語", "😀 é", " x y"):
        assert ENCODER(text) == ENCODER.whole(text)


class Counting:
    """A model that counts what it is asked for."""

    def __init__(self, model):
        self.model, self.asked = model, Counter()

    def tokenize(self, letters):
        self.asked[letters] += 1
        return self.model.tokenize(letters)


def test_frequent_pre_tokens_are_encoded_once(monkeypatch):
    """The work for a text grows with its rare pre-tokens only, and the memory for them is bounded."""
    monkeypatch.setattr(packing, "MEMORY", 50)
    encoder = packing.Encoder(BPE)
    model = Counting(encoder.tokenizer.model)
    encoder.known = packing.Known(model)
    frequent = [" the", " Größe", ",", " of", "\n"]
    for i in range(100):
        text = "".join(frequent) + f" x{i}y" + "".join(frequent) + " z" * 3
        assert encoder(text) == encoder.whole(text)
    letters = {w.encode().decode("latin-1").translate(packing.byte_letters()) for w in frequent}
    assert {model.asked[w] for w in letters} == {1}
    assert len(encoder.known) <= 50


def test_long_pre_tokens_are_not_remembered():
    encoder = packing.Encoder(BPE)
    for text in ("a" * 5000, " " + "é" * 5000, "-" * 5000, "7" * 5000, " " * 5000, "b" * 64):
        assert encoder(text) == encoder(text) == encoder.whole(text)
    assert sum(map(len, encoder.known)) <= 64


def test_letters_and_digits_of_plain_texts():
    plain = [c for c in map(chr, range(0x110000)) if not packing.PLAIN.search(c)]
    letter, space = re.compile(f"[{packing.LETTERS}]"), re.compile(r"\s")
    for c in plain:
        kind = unicodedata.category(c)[0]
        assert bool(letter.fullmatch(c)) == (kind == "L") and (c in "0123456789") == (kind == "N"), c
        assert bool(space.fullmatch(c)) == (c in " \t\n\v\f\r"), c


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=200), st.integers(1, 6))
def test_best_fit_against_a_plain_search(lengths, limit):
    packer, bins, opened = packing.BestFit(20, limit), [], []
    for n in lengths:
        chosen, offset = packer.place(n)
        fits = [b for b in opened if 20 - bins[b] >= n]
        if fits:
            assert 20 - bins[chosen] == min(20 - bins[b] for b in fits)
        else:
            if len(opened) == limit:
                opened.remove(next(b for b in reversed(opened) if bins[b] == max(bins[b] for b in opened)))
                # of equally full bins any may close; take the packer's view of what is open
                opened = sorted(x for at in packer.with_space for x in at if x != chosen)
            assert chosen == len(bins)
            bins.append(0)
            opened.append(chosen)
        assert offset == bins[chosen]
        bins[chosen] += n
        if bins[chosen] == 20:
            opened.remove(chosen)


def test_bins_close_and_cost_little(spark, documents):
    random.seed(4)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "50")
    rows = [(i, " the" * (random.randint(1, 60) - 1)) for i in range(3000)]
    lengths = {}
    for limit in (10, 1 << 12):
        packed = packing.pack(documents(*rows), BPE, capacity=64, open_bins=limit).toPandas()
        used = packed.groupby("sequence_id").length.sum()
        assert len(packed) == 3000 and used.max() <= 64 and packed.groupby("sequence_id").offset.min().max() == 0
        lengths[limit] = len(used)
    spark.conf.set(name, before)
    # With 10 open bins of about 1,500 the fullest have to close; that costs a few sequences in a hundred.
    assert lengths[1 << 12] < lengths[10] < 1.1 * lengths[1 << 12]


def test_packed_documents(documents):
    random.seed(2)
    rows = [(i, " ".join(random.choice(("the", "quick", "Zebra", "x1")) for _ in range(random.choice((3, 50, 900, 2600))))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a"), (102, "a"), (None, "b c")]
    got = packing.pack(documents(*rows), BPE, ids=True).collect()
    texts = defaultdict(list)
    for i, t in rows:
        texts[str(i)].append(ENCODER.whole(t or "") + np.array([2], "<u4").tobytes())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[str(r["id"])].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
    for i, own in pieces.items():
        own.sort(key=lambda r: (r["piece"], r["sequence_id"], r["offset"]))
        if i != "102":
            assert [b"".join(bytes(r["ids"]) for r in own)] == texts[i]
            assert [r["piece"] for r in own] == list(range(len(own)))
            assert [r["start"] for r in own] == np.cumsum([0, *[r["length"] for r in own]])[:-1].tolist()
            assert all(r["length"] == 1024 for r in own[1:])
    assert len(pieces["102"]) == 2 and set(pieces) == set(texts)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in got)
    assert len(sequences) <= total / 1024 * 1.02 + 1
    assert packing.pack(documents((1, "a")).limit(0), BPE).collect() == []


def test_word_pattern_is_shared():
    assert re.fullmatch(r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r")


def test_batches_of_long_texts_are_bounded(spark, documents, tmp_path):
    """By bytes and rows, those for Python and those that are read; a smaller setting stays."""
    before = {name: spark.conf.get(name) for name in BOUNDS}
    try:
        for name in BOUNDS:
            spark.conf.unset(name)
        prepare(spark)
        documents(*((i, "x" * (1 << 20)) for i in range(40))).coalesce(1).write.parquet(f"{tmp_path}/docs")

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"rows": [len(batch)], "bytes": [batch.nbytes]})

        docs = spark.read.parquet(f"{tmp_path}/docs").select("text")
        got = docs.mapInArrow(sizes, "rows long, bytes long").toPandas()
        assert got.rows.sum() == 40 and got.bytes.max() < 8 << 20
        assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
        prepare(spark)
        assert docs.mapInArrow(sizes, "rows long, bytes long").toPandas().bytes.max() < 4 << 20
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
