"""Exact and near deduplication against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from careerloom.llm import exact_dedup, minhash
from careerloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def check_exact(df, rows):
    got = sorted((r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"]) for r in df.collect())
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    expected = sorted(
        (i, max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest())
        for i, t in rows
    )
    assert got == expected


ROWS = [
    (1, "Hello World"), (2, "hello world"), (3, "hello  world"), (4, None), (5, ""), (6, " "), (7, "ÄB"), (8, "äb"),
    (9, "Äb"), (10, "x" * 200_000), (11, "X" * 200_000), *[(100 + i, "copy") for i in range(60)],
]


def test_exact_copies(documents):
    check_exact(exact_dedup.exact_dedup(documents(*ROWS)), ROWS)


def test_exact_empty_table(documents, spark):
    empty = exact_dedup.exact_dedup(documents(*ROWS).limit(0))
    assert empty.collect() == []


def test_hits_are_compared_in_full(documents):
    """Texts with the same digest but other bytes are kept apart."""
    df = exact_dedup.exact_dedup(documents(*ROWS), digest=lambda text: F.length(text).cast("string"))
    got = {r["id"]: (r["keep_id"], r["group_size"]) for r in df.collect()}
    assert got[2] == (2, 2) and got[3] == (3, 1) and got[11] == (11, 2) and got[7] == (9, 2) and got[150] == (159, 60)


def test_exact_repeated_rows_and_null_ids(documents):
    df = documents((1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b"))
    got = sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df).collect())
    assert got == [
        ("1", "1", 3, False), ("1", "1", 3, True), ("None", "1", 3, False), ("None", "None", 2, False), ("None", "None", 2, True),
    ]
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns and kept.count() == 2


def test_stream_adds_to_its_state(spark, documents, tmp_path):
    """Micro-batches meet the state that earlier ones left."""
    path = str(tmp_path / "entries")
    rows = documents(*[(i, f"t{i % 7}") for i in range(70)]).selectExpr(
        "doc_id AS id", "text AS digest", "'f' AS at_file", "doc_id AS at_row"
    )
    rows.repartition(5).write.parquet(path)
    before = exact_dedup.BATCH_BYTES
    exact_dedup.BATCH_BYTES = 1
    try:
        state = exact_dedup.digest_state(spark.read.parquet(path), path)
    finally:
        exact_dedup.BATCH_BYTES = before
    assert sorted((r["digest"], r["group_size"], r["keep"]["id"]) for r in state.collect()) == [
        (f"t{k}", 10, 63 + k) for k in range(7)
    ]


def test_state_outlives_a_run(spark, documents, tmp_path):
    """A later run takes up the files that are new, and its hits meet what the earlier one kept."""
    path, checkpoint = str(tmp_path / "entries"), str(tmp_path / "state")
    columns = ["doc_id AS id", "text AS digest", "'f' AS at_file", "doc_id AS at_row"]
    documents((1, "a"), (2, "b")).selectExpr(*columns).write.parquet(path)
    first = exact_dedup.digest_state(spark.read.parquet(path), path, checkpoint)
    assert sorted((r["digest"], r["group_size"], r["keep"]["id"]) for r in first.collect()) == [("a", 1, 1), ("b", 1, 2)]
    documents((5, "a"), (6, "c")).selectExpr(*columns).write.mode("append").parquet(path)
    later = exact_dedup.digest_state(spark.read.parquet(path), path, checkpoint)
    assert sorted((r["digest"], r["group_size"], r["keep"]["id"]) for r in later.collect()) == [
        ("a", 2, 5), ("b", 1, 2), ("c", 1, 6),
    ]


def shingle_set(text, width):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_groups(rows, width):
    sets = [shingle_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(sets[k]), least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(rows))


def near_rows():
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = [random.choice(vocabulary) for _ in range(random.choice((3, 5, 30, 120)))]
        for copy in range(14):
            words = list(base)
            for _ in range(random.choice((0, 0, 1, 2, 3))):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append((group * 100 + copy, " ".join(words).title() if copy % 3 else " ".join(words)))
    return rows + [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "one"), (5004, "ONE"), (5005, "one two three")]


def test_near_groups(documents):
    rows = near_rows()
    got = sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_groups(documents(*rows)).collect())
    assert got == brute_groups(rows, 4)


def test_near_groups_in_blocks(documents, monkeypatch):
    """Buckets are compared in blocks when they are large."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = near_rows()
    got = sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_groups(documents(*rows), width=5).collect())
    assert got == brute_groups(rows, 5)


def test_near_edge_cases(documents):
    assert minhash.near_groups(documents((1, "a")).limit(0)).collect() == []
    long = " ".join(f"w{i}" for i in range(60_000))
    df = documents((3, long), (2, long.upper()), (3, long), (None, "a b c d e"), (None, "a b c d e"), (None, None))
    got = sorted((str(r["id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in minhash.near_groups(df).collect())
    assert got == [
        ("2", 59_997, "2", True), ("3", 59_997, "2", False), ("3", 59_997, "2", False),
        ("None", 0, "None", True), ("None", 2, "None", True), ("None", 2, "None", True),
    ]
    kept = minhash.keep_one(documents((1, "a b c d e f"), (2, "a b c d e f"), (3, "other words than those of it")))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1060)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        if low != high:
            root[high] = low
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_chains_and_small_graphs(spark):
    """No node is left with edges to two roots; every node has one row and the smallest node that it reaches."""

    def check(edges):
        got = sorted(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
        root = {x: x for e in edges for x in e}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            low, high = sorted((find(a), find(b)))
            root[high] = low
        assert got == sorted((x, find(x)) for x in root)

    check([(1, 5), (5, 4), (4, 3), (3, 2)])
    # The loop ends when all graphs are done, so one length at a time.
    random.seed(7)
    for length in (5, 6, 9):
        edges = []
        for graph in range(200):
            nodes = [100 * graph + i for i in range(length)]
            random.shuffle(nodes)
            edges += zip(nodes, nodes[1:], strict=False)
            if graph % 3 == 0:
                edges.append((nodes[0], nodes[length // 2]))
        check(edges)


def test_one_of_each_near_group_stays(documents):
    """Rows go one by one: those that share an id, or have none, don't share their fate."""
    base, other = "a b c d e f g h i j k l m n o p q r s t u v w x y z", " ".join(f"o{i}" for i in range(30))
    near, none = f"{base} end", " ".join(f"n{i}" for i in range(30))
    rows = [
        (1, base), (None, near), (None, "alone without an id or any copy"), (None, "another one of these"),
        (7, "only here under this very id"), (7, other + " end"), (3, other), (9, "x1 x2 x3 x4 x5"), (9, "X1 x2 x3 x4 x5"),
        (None, none), (None, none + " end"), (None, None), (None, None),
    ]
    df = documents(*rows)
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    left = [r for r in got if r[1] and r[1].lower() != rows[7][1] and not r[1].startswith("n0")]
    assert left == sorted([rows[0], *rows[2:5], rows[6]], key=repr)
    assert sum(i == 9 for i, _ in got) == 1 and sum((t or "").startswith("n0") for _, t in got) == 1
    assert got.count((None, None)) == 2


def test_near_copies_without_ids(documents, monkeypatch):
    """Texts are fetched by their place, so rows without an id don't multiply."""
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join([*base, f"end{i}"])) for i in range(150)] + [(7, " ".join(base)), (7, "x y z a b c"), (7, "q r s t u v")]
    seen = []
    keep = minhash.written
    monkeypatch.setattr(minhash, "written", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    got = minhash.near_groups(documents(*rows)).collect()
    assert sorted((r["id"] or 0, r["component_id"]) for r in got) == [(0, 7)] * 150 + [(7, 7)] * 3
    sets = next(df for name, df in seen if name == "near-sets")
    assert sets.count() == 151 == sets.select("node").distinct().count()
