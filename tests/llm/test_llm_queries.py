"""The registered queries over whole tables, against SQL or plain Python."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from test_dedup import brute_groups, lower
from test_layout import ENCODER
from test_text import brute_items, brute_scores

import __spark_entry__ as entry
import corpus_pipeline
from careerloom.llm import language_id
from tools.check import connect, normal

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet").toPandas() for n in ("documents", "pages", "benchmark", "labels")}


@pytest.fixture(scope="module")
def texts(tables):
    return list(zip(tables["documents"].doc_id.tolist(), [t or "" for t in tables["documents"].text], strict=True))


def run(spark, name):
    return entry.queries()[name](spark, FOLDER).toPandas()


def crc(i):
    return zlib.crc32(str(i).encode())


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if re.match(r"op\d+_", n)])
def test_query_matches_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    ours = normal([tuple(r) for r in df.collect()], df.columns)
    result = connect(FOLDER).execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns) and ours and ours == normal(result.fetchall(), names)


def test_op2(spark, texts):
    got = run(spark, "op2_histogram_sharding")
    own = dict(texts)
    assert sorted(got.doc_id) == sorted(own)
    assert all(s == len(own[i].encode()) + 16 and c == zlib.crc32(own[i].encode()) for i, s, c in got[["doc_id", "size", "text_crc32"]].values)
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    sizes = got.groupby("shard")["size"].sum().reindex(range(40), fill_value=0)
    assert sizes.max() - sizes.min() <= 2 * got["size"].max() and set(got.law) == {"bytes"}


def test_op3(spark, tables):
    got = run(spark, "op3_warc").set_index("page_id")
    first = {}
    for i, html in sorted(zip(tables["pages"].page_id, tables["pages"].html, strict=True)):
        data = (html or "").encode()
        row = got.loc[i]
        assert row.payload_bytes == len(data)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (row.record_type, row.refers_to) == (("revisit", first[data]) if data in first else ("response", row.refers_to))
        assert data in first or np.isnan(row.refers_to or np.nan)
        first.setdefault(data, i)
    assert len(got) == len(tables["pages"])


def test_op4(spark, texts):
    from careerloom.llm.language_model import MASS

    got = run(spark, "op4_backoff_scores")
    assert all(h == (crc(i) % 7 == 2) for i, h in zip(got.doc_id, got.held_out, strict=True))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    ours = sorted((str(r[0]), *r[1:]) for r in got[["doc_id", *columns]].itertuples(index=False))
    expected = brute_scores(texts, lambda i: crc(i) % 7 != 2, MASS)
    assert [o[:4] for o in ours] == [e[:4] for e in expected]
    np.testing.assert_allclose([o[4:] for o in ours], [e[4:] for e in expected], rtol=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_op5(spark):
    # The smallest tables have 19 held-out labels only.
    folder = "/root/testdata/sf0.01"
    tables = {n: spark.read.parquet(f"{folder}/{n}.parquet").toPandas() for n in ("documents", "labels")}
    got = entry.queries()["op5_quality_trees"](spark, folder).toPandas()
    assert len(got) == len(tables["documents"]) and got.score.between(0, 1).all()
    assert all(h == (crc(i) % 5 == 0) for i, h in zip(got.doc_id, got.held_out, strict=True))
    held = got[got.held_out].merge(tables["labels"], on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9 and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_op6(spark, texts):
    from careerloom.llm.licenses import TEMPLATES

    got = run(spark, "op6_license_scan")
    found = {(i, n) for i, t in texts for n, x in TEMPLATES.items() if x.text in t}
    assert found and found <= set(zip(got.doc_id, got.license, strict=True))
    assert got.coverage.between(0.8, 1).all()


def test_op8(spark, tables):
    got = run(spark, "op8_language_id").merge(tables["documents"], on="doc_id")
    assert len(got) == len(tables["documents"]) and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert all(h == (crc(i) % 5 == 0) for i, h in zip(got.doc_id, got.held_out, strict=True))
    assert (held.lang_pred == held.lang).mean() > 0.98


def packed_right(got, texts):
    pieces = defaultdict(list)
    for r in got.itertuples(index=False):
        pieces[r.doc_id].append(r)
    assert set(pieces) == {i for i, _ in texts}
    for i, t in texts:
        ids = ENCODER.whole(t) + b"\x02\0\0\0"
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids) // 4 and [r.piece for r in own] == list(range(len(own)))
        assert all(zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 for r in own)
        assert all(r.length == 1024 for r in own[1:])
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.cumsum([0, *g.length])[:-1].tolist() and g.length.sum() <= 1024


def test_op9(spark, texts):
    packed_right(run(spark, "op9_best_fit_packing"), texts)


def test_pipeline(spark, tables, texts):
    """Every stage's decisions, taken again in plain Python; the language model is fitted by its own function."""
    from pyspark.sql import functions as F

    from careerloom.llm.common import remainder

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.fit(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    scores = {r["id"]: r["score"] for r in language_id.predict(docs, *model).collect()}
    rows = [(i, t) for i, t in texts if scores[i] >= 0.5]
    last = {}
    for i, t in rows:
        last[lower(t)] = max(i, last.get(lower(t), i))
    rows = [(i, t) for i, t in rows if last[lower(t)] == i]
    keep = {i for i, _, least, _ in brute_groups(rows, 5) if i == least}
    rows = [(i, t) for i, t in rows if i in keep]
    items = list(zip(tables["benchmark"].item_id, tables["benchmark"].text, strict=True))
    dirty = {i for i, *_ in brute_items(rows, items)}
    rows = [(i, t) for i, t in rows if str(i) not in dirty]
    assert dirty and len(rows) < len(texts)
    packed_right(run(spark, "pipeline"), rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns


def test_stages_take_odd_rows(spark, documents):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    plain = "the words of this text are known to be of one language and no other"
    long = " ".join(f"word{i} and" for i in range(30_000))
    rows = [(i, f"{plain} number{i} " + "these those " * (i % 7), "en") for i in range(40)] + [
        (100, None), (None, None), (101, ""), (102, " \n\t"), (103, "12 %% 34"), (104, long, "en"), (105, long.upper(), "en"),
        (106, plain, "en"), (106, plain, "en"), (None, plain + " null", None),
    ]
    docs, seen = documents(*rows), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        seen.append({(r["doc_id"], r["text"]) for r in docs.collect()})
        assert len(seen[-1]) == docs.count() or len(seen) == 1
    assert not {100, 101, 102, 103} & {i for i, _ in seen[0]}
    assert (104, long) in seen[0] and (104, long) not in seen[1] and (105, long.upper()) in seen[3]
    assert any(i is None for i, _ in seen[1])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 1024 and packed.length.sum() > 60_000


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0
