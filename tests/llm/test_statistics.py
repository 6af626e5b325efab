"""Whitening, the divergence audit and byte-level BPE, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import documents  # noqa: F401

import __spark_entry__ as entry
from careerloom.llm import byte_bpe, divergence, whitening
from careerloom.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# Whitening


def brute_whitened(vectors, most=16):
    x = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), np.int64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - np.array(sums) / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1][:most], vecs[:, ::-1][:, :most]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    whitened = (np.array(x) - np.array(sums) / n) @ vecs / np.sqrt(values)
    return n, deviation, whitened, values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("block_bytes", [8 * 5 * 3, 1 << 16])
def test_whitening_equals_brute_force(spark, block_bytes):
    prepare(spark)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 5)) * [5, 4, 3, 2, 1]
    vectors = np.concatenate([vectors, vectors[:1].repeat(40, 0)])  # one vector holds two fifths of the rows
    df = spark.createDataFrame([(i, v.tolist(), "x", "y") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, x string, ids string")
    got = whitening.whiten(df.repartition(4), block_bytes=block_bytes).toPandas().sort_values(["id", "component"])
    n, deviation, whitened, explained = brute_whitened(vectors)
    assert len(got) == 500 and (got.n == n).all() and n == 60
    assert got.deviation.tolist() == [d for d in deviation for _ in range(5)]
    own = got.whitened.to_numpy().reshape(100, 5)
    signs = np.sign((own * whitened).sum(axis=0))
    assert np.allclose(own, whitened * signs, atol=1e-9)
    assert np.allclose(got.explained.to_numpy()[:5], explained, rtol=1e-9) and got.identity_error.max() < 1e-9


def test_whitening_drops_unusable_vectors_only(spark):
    prepare(spark)
    rows = [
        (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [0.0, 1.0]), (2, [-1.0, -1.0]), (4, None), (5, []), (6, [1.0]),
        (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [None, 1.0]), (10, [1e300, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).toPandas()
    assert sorted(got.id.fillna(-1).astype(int)) == [-1, -1, 1, 1, 2, 2, 2, 2] and (got.n == 3).all()
    assert whitening.whiten(df.filter("false")).count() == 0 and whitening.whiten(df.filter("vec_id in (4, 7)")).count() == 0


def test_whitening_without_variance(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], "vec_id long, embedding array<float>")
    got = whitening.whiten(df).toPandas().sort_values(["id", "component"])
    assert got.whitened.abs().tolist()[::2] == [1.0, 1.0] and got.whitened.isna().tolist()[1::2] == [True, True]
    assert got.explained.tolist() == [1.0, 0.0] * 2 and got.identity_error.max() < 1e-12
    single = whitening.whiten(df.filter("vec_id = 1")).toPandas()
    assert single.whitened.isna().all() and single.identity_error.isna().all() and (single.deviation == 0).all()


def test_large_deviations_are_exact_or_null(spark):
    centre = whitening.Centre(3, [3 << 40, 6, 9])
    x = np.array([[(1 << 40) + 5, 2, 3], [(1 << 60), 2, 3]], np.int64)
    assert centre.deviations(x) == [225, None]


def test_op11(spark):
    got = entry.queries()["op11_embedding_whitening"](spark, FOLDER).toPandas().sort_values(["vec_id", "component"])
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, whitened, explained = brute_whitened([r["embedding"] for r in rows])
    assert (got.n == n).all() and got.deviation.tolist() == [d for d in deviation for _ in range(16)]
    assert np.allclose(np.abs(got.whitened.to_numpy().reshape(-1, 16)), np.abs(whitened), atol=1e-8)
    assert got.identity_error.max() < 1e-9 and np.allclose(got.explained.to_numpy()[:16], explained)


# Divergence


def brute_audit(rows, least=3, most=200):
    rows = [tuple(v or "" for v in r) for r in rows]
    found = [(g, s, Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))) for t, g, s in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        docs[lang].update(list(terms))
        counts[lang, source].update(terms)
    result = []
    for lang in {g for g, _, _ in found}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: counts[lang, s] for g, s in counts if g == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)
        for s in groups:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, values, limit in (("pair", pairs, None), ("term", terms, most)):
                ordered = sorted(values, key=lambda v: (-v[0], v[1].encode()))[:limit]
                result += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(ordered)]
    return sorted(result)


def audited(df, **options):
    return sorted(tuple(r) for r in divergence.audit(df, **options).collect())


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_audit_equals_brute_force(spark, sources):
    prepare(spark)
    rng = np.random.default_rng(sources)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}é" for i in range(300)]
    rows = []
    for _ in range(200):
        source = f"s{rng.integers(sources)}" if rng.random() > 0.3 else "s0"  # a third comes from one source
        rows.append((" ".join(words[min(299, int(rng.pareto(0.7) * 3))] for _ in range(rng.integers(0, 30))), "en" if rng.random() < 0.8 else None, source))
    rows += [(None, "en", None), ("", "xx", "a"), ("only once", "xx", "b"), ("A1b_a B", "en", "s0")] * 2
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: divergence.F.lit("clash") for c in ("term", "place", "n")})
    want = brute_audit(rows)
    assert audited(df) == want and any(r[2] == "term" for r in want) == (sources > 1)
    # Tiles of a few terms give the same rows.
    assert audited(df, tile_counts=20, tile_cells=200, most=200) == want


def test_audit_of_nothing(spark, documents):  # noqa: F811
    prepare(spark)
    assert audited(documents().limit(0)) == []
    assert audited(documents((1, "a b", "en"), (2, None, "en"))) == []


def test_shares_are_exact():
    counts, sums, kept = [0, 1, 10**9, 7 * 10**14], [10**15, 3, 10**9, 7 * 10**14], 12345
    got = divergence.shares(np.array(counts), np.array(sums), kept).tolist()
    assert got == [1 + 10**9 * (c + 1) // (s + kept) for c, s in zip(counts, sums, strict=True)]


def test_walk_prices_every_column_once():
    rng = np.random.default_rng(1)
    for n_rows, n_cols in ((1, 1), (3, 100), (17, 33), (50, 500)):
        cells = np.unique(rng.integers(0, n_rows * n_cols, 40))
        tree = divergence.CountTree(cells // n_cols, cells % n_cols, np.ones(len(cells), np.int64), n_rows, n_cols)
        empty, (i, j, c) = divergence.walk(tree)
        for a, b, col in zip(i, j, c, strict=True):
            empty[a * 16 : a * 16 + 16, b * 16 : b * 16 + 16] += min(16, n_cols - col * 16)
        assert (empty == n_cols).all()


# Byte-level BPE


@pytest.fixture(scope="module")
def tokenizer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "", "Hello  world \n\n x", "it's  'S we'll", "  ", " \t x y  z", "a\x1cb\x1d c\x85d", "漢字かな 123 ４５", "😀👩‍👩‍👧 ñandú",
    "new ࢏ letter ꟒x", "<|endoftext|> stays text", "\x00\x01 a", "½²①Ⅷ", "é" * 50, "!!!???...", "́ combining á",
]


def split_words(split, text):
    numbers, names = split(text), list(split.words)
    return [names[n] for n in numbers]


def test_encode_equals_the_tokenizer(spark, documents, tokenizer):  # noqa: F811
    prepare(spark)
    long = "word " * 3000 + "x" * 5000 + " \n".join(ODD)
    texts = [*ODD, None, long, long, *["same text"] * 30]
    df = documents(*((i if i % 7 else None, t) for i, t in enumerate(texts))).repartition(3)
    vocabulary = byte_bpe.Vocabulary(spark, RANKS)
    for block, bucket in ((1 << 10, 1 << 12), (1 << 24, 1 << 24)):
        encoded = byte_bpe.encode(df, vocabulary, public_tokenizers.PATTERN, block_chars=block, bucket_bytes=bucket)
        got = byte_bpe.decode(encoded, vocabulary)
        rows = Counter((r["id"], tuple(r["ids"]), bytes(r["bytes"])) for r in got.collect())
        want = ((i if i % 7 else None, tuple(tokenizer.encode_ordinary(t or "")), (t or "").encode()) for i, t in enumerate(texts))
        assert rows == Counter(want)
    assert byte_bpe.encode(df.limit(0), vocabulary, public_tokenizers.PATTERN).count() == 0


def test_parts_begin_where_pre_tokens_do(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART", 7)
    split = byte_bpe.Splitter(public_tokenizers.PATTERN)
    for text in [*ODD, " a  b   c\n\nd e's 12 \n x" * 20, "aa   bbb    \n ccc" * 9]:
        words = split_words(split, text)
        assert "".join(words) == text
        assert [i for w in words for i in tokenizer.encode_ordinary(w)] == tokenizer.encode_ordinary(text)


def test_every_character_is_split_as_by_the_tokenizer(tokenizer):
    split = byte_bpe.Splitter(public_tokenizers.PATTERN)
    for code in [*range(0, 0xD800, 3), *range(0xE000, 0x110000, 101)]:
        split = byte_bpe.Splitter(public_tokenizers.PATTERN) if code % 5000 == 0 else split
        text = f"a{chr(code)}1{chr(code)} {chr(code)} x"
        found = [i for w in split_words(split, text) for i in tokenizer.encode_ordinary(w)]
        assert found == tokenizer.encode_ordinary(text), code


def test_decode_of_what_is_no_token(spark):
    prepare(spark)
    rows = [(1, [0, 1]), (2, [0, 99_999]), (3, None), (4, [None]), (5, []), (6, [-1])]
    df = spark.createDataFrame(rows, "id long, ids array<int>")
    got = {r["id"]: r["bytes"] and bytes(r["bytes"]) for r in byte_bpe.decode(df, byte_bpe.Vocabulary(spark, RANKS)).collect()}
    assert got == {1: b'!"', 2: None, 3: None, 4: None, 5: b"", 6: None}


def test_op13(spark, tokenizer):
    got = entry.queries()["op13_byte_bpe"](spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        ids = tokenizer.encode_ordinary(texts[r["doc_id"]])
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        own = hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha, own)
