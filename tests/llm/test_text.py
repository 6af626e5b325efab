"""Decontamination, language models, language identification, quality, licenses: against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from careerloom.llm import decontaminate, language_id, language_model, licenses, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute_items(docs, items):
    found = set()
    for item, text in items:
        width = min(5, len(words(text)))
        own = runs(text, width) if width else set()
        for doc, t in docs:
            if own and 100 * len(own & runs(t, width)) >= 80 * len(own):
                found.add((str(doc), item, len(own & runs(t, width)), len(own)))
    return sorted(found)


def test_contained_items(documents, spark):
    random.seed(4)
    vocabulary = [f"v{i}" for i in range(60)]

    def text(n):
        return " ".join(random.choice(vocabulary) for _ in range(n))

    items = [(i, text(n)) for i, n in enumerate((1, 2, 3, 4, 5, 6, 9, 20, 40, 63, 64, 200))] + [(50, None), (51, " "), (52, "a b a b a b a")]
    docs = []
    for k in range(150):
        own = words(random.choice(items)[1])
        for _ in range(random.choice((0, 0, 1, 3))):
            if own:
                own[random.randrange(len(own))] = "zzz"
        docs.append((k, f"{text(30)}  {' '.join(own).upper()}\n{text(random.choice((0, 5, 400)))}"))
    docs += [(900, None), (901, ""), (902, items[8][1]), (902, items[8][1]), (None, items[9][1])]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("clash"))
    got = decontaminate.contained_items(documents(*docs), table)
    assert sorted((str(r["id"]), r["item_id"], r["n_shared"], r["n_item"]) for r in got.collect()) == brute_items(docs, items)
    kept = decontaminate.drop_contaminated(documents(*docs), table)
    dirty = {d for d, *_ in brute_items(docs, items)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if str(d) not in dirty)


def test_only_contaminated_rows_go(documents, spark):
    """A row without an id, or with a repeated one, takes no other row with it."""
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    rows = [(None, "a b c d e f"), (None, "clean"), (None, None), (7, "x a b c d e f"), (7, "also clean")]
    kept = decontaminate.drop_contaminated(documents(*rows), items)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([rows[1], rows[2], rows[4]], key=repr)


@pytest.mark.parametrize("which", ["documents", "items"])
def test_nothing_to_search(documents, spark, which):
    docs, items = documents((1, "a b c d e f")), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs, items = (docs.limit(0), items) if which == "documents" else (docs, items.limit(0))
    assert decontaminate.contained_items(docs, items).collect() == []
    assert decontaminate.drop_contaminated(docs, items).count() == docs.count()


def test_decontamination_runs_no_python(documents, spark):
    docs, items = documents((1, "a b c d e f")), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.contained_items(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_scores(rows, train, mass):
    tokens = {k: [*words(t), ""] for k, (_, t) in enumerate(rows)}
    single, pairs, triples = Counter(), Counter(), Counter()
    for k, (i, _) in enumerate(rows):
        if train(i):
            single.update(tokens[k])
            pairs.update(zip(["", *tokens[k]], tokens[k], strict=False))
            triples.update(zip(["", *tokens[k]], tokens[k], tokens[k][1:], strict=False))
    n, v = sum(single.values()), len(single)
    out = []
    for k, (i, _) in enumerate(rows):
        p = [(single[w] + 1) / (n + v + 1) for w in tokens[k]]
        two = [
            (pairs[h, w] + mass * q) / (single[h] + mass) for h, w, q in zip(["", *tokens[k]], tokens[k], p, strict=False)
        ]
        s = two[:1] + [
            (triples[g, h, w] + mass * q) / (pairs[g, h] + mass)
            for g, h, w, q in zip(["", *tokens[k]], tokens[k], tokens[k][1:], two[1:], strict=False)
        ]
        logs = [sum(map(math.log10, x)) for x in (p, s)]
        out.append((str(i), len(tokens[k]), sum(single[w] > 0 for w in tokens[k]), n, *logs))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_language_model(documents, block_bytes):
    random.seed(6)
    rows = [(i, " ".join(random.choice("abcdefgh") * random.choice((1, 2)) for _ in range(random.randrange(60)))) for i in range(90)]
    rows += [(500, None), (501, ""), (502, "\n "), (503, "unknown words"), (504, "A b"), (504, "A b"), (None, "a b"), (506, "a " * 30_000)]
    scored = language_model.score(documents(*rows), F.col("doc_id") % 5 != 0, mass=7.0, block_bytes=block_bytes)
    got = sorted(
        (str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in scored.collect()
    )
    expected = brute_scores(rows, lambda i: i is not None and i % 5 != 0, 7.0)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    np.testing.assert_allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-9, atol=1e-9)


def test_model_sums_to_one():
    """All words and one unknown word, after two words that were seen together, two that were not, and one word alone."""
    n_words, n_pairs, n_triples = np.array([3, 2, 1, 0]), np.array([2, 1, 0, 0, 2]), np.array([1, 1, 0, 0])
    a = language_model.BackoffAutomaton(n_words, n_pairs, n_triples, 6, 3, 5.0)
    seen, unseen, none = np.arange(4), np.full(4, 3), np.full(4, 2)

    def after(state, before, pairs, triples):
        """Probabilities of the words as second token, where the first one is given."""
        return sum(
            10 ** a.run(np.array([before, w]), np.array([state, pairs[w]]), np.array([2, triples[w]]), 0, np.array([0]))[1]
            for w in range(4)
        )

    assert after(4, 0, seen, seen) == pytest.approx(1)
    assert after(2, 0, seen, none) == pytest.approx(1)
    assert after(2, 3, unseen, none) == pytest.approx(1)
    alone = [10 ** a.run(np.array([w]), seen[w : w + 1], none[:1], 0, np.array([0]))[0] for w in range(4)]
    assert sum(alone) == pytest.approx(1)


def test_repeated_rows_spread_over_blocks(documents):
    """Copies of a row, without an id too, are dealt out like other rows, and a block asks where it has keys only."""
    rows = [(None, "the same text")] * 400
    got = language_model.score(documents(*rows), F.lit(True), block_bytes=500).collect()
    assert len(got) == 400 and len({r["score"] for r in got}) == 1 and got[0]["train_tokens"] == 1600
    keys = np.array([1, 5, 1 << 63], np.uint64)
    asked = language_model.asking(7, {1: (keys, np.array([1, 2, 3]))}, 1 << 20)
    assert asked.column("slice").to_pylist() == [0, 1 << 19] and asked.column("block").to_pylist() == [7, 7]


def test_model_without_training_rows(documents):
    got = language_model.score(documents((1, "a b"), (2, None)), F.lit(False)).collect()
    assert all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == r["n_known"] == 0 for r in got)
    assert language_model.score(documents((1, "a")).limit(0), F.lit(True)).collect() == []


LANGUAGES = {"en": "the of and to in that was with", "de": "der die und das nicht für über", "fr": "le la les été où être une"}


def language_rows():
    random.seed(8)
    return [
        (i, " ".join(random.choice(LANGUAGES[lang].split()) for _ in range(30)), lang)
        for i, lang in enumerate(list(LANGUAGES) * 40)
    ]


def test_language_identification(documents):
    rows = language_rows()
    model = language_id.fit(documents(*[r for r in rows if r[0] % 4]))
    odd = [(900, None), (901, ""), (902, "12 34 !?"), (903, "the"), (903, "the"), (None, "und nicht")]
    got = {(r["id"], r["lang_pred"]): r["score"] for r in language_id.predict(documents(*rows, *odd), *model).collect()}
    assert sum((i, lang) in got for i, _, lang in rows) == len(rows)
    assert got[900, "und"] == got[901, "und"] == got[902, "und"] == 0
    assert (903, "en") in got and (None, "de") in got and all(0 <= s <= 1 for s in got.values())
    kept = language_id.keep_known(documents(*rows, *odd), *model)
    assert kept.count() == len(rows) + 3


def test_scores_are_those_of_naive_bayes(documents):
    rows = [(1, "ab a", "x"), (2, "b", "y"), (3, "ab", "x"), (4, None, "y"), (5, "zz", None)]
    names, matrix = language_id.fit(documents(*rows))
    assert names == ["x", "y"]
    counted = language_id.counts("ab a") + language_id.counts("ab") + language_id.SMOOTHING
    np.testing.assert_allclose(matrix[0], np.log(counted / counted.sum()), rtol=1e-5)
    log = [language_id.counts("ba").astype(float) @ m for m in matrix]
    got = language_id.predict(documents((9, "ba")), names, matrix).first()
    assert got["lang_pred"] == names[int(np.argmax(log))]
    assert got["score"] == pytest.approx(1 / (1 + math.exp(min(log) - max(log))), rel=1e-5)


def test_long_texts_count_whole(monkeypatch):
    text = "abc déf, " * 700 + "½ ² x"
    whole = language_id.counts(text)
    normal = " " + "abc déf " * 700 + "½ ² x "
    assert whole.sum() == sum(len(normal) - k for k in range(3))
    monkeypatch.setattr(language_id, "CHUNK", 7)
    assert (language_id.counts(text) == whole).all()


def test_numerals_are_no_letters(documents):
    model = language_id.fit(documents((1, "ab", "x"), (2, "cd", "y")))
    got = language_id.predict(documents(*enumerate(["½", "² ① Ⅷ", "1½b", "_ 5", "ª"])), *model).collect()
    assert [r["lang_pred"] == "und" for r in sorted(got, key=lambda r: r["id"])] == [True, True, False, True, False]


def test_no_language_is_learned(documents):
    model = language_id.fit(documents((1, "a", None)))
    assert language_id.predict(documents((1, "abc")), *model).first()["lang_pred"] == "und"


def test_quality(documents, spark):
    random.seed(9)
    good = ["".join(random.choice("abcdeo") for _ in range(random.randrange(2, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [random.choice(good) for _ in range(60)]
        bad = i % 3 == 0
        rows.append((i, " ".join(x + random.choice(("$$$", "&&&")) if bad else x for x in w) + "."))
        labels += [(i, int(not bad))] if i % 2 else []
    labels += [(1, 0), (1, 1), (3, None), (None, 1), (9999, 1)]
    rows += [(1000, None), (1001, ""), (1001, ""), (None, "good words"), (1002, "long " * 50_000)]
    table = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    scores = {r["id"]: r["score"] for r in quality.quality_scores(documents(*rows), table, F.col("id") % 5 != 0).collect()}
    assert len(scores) == 600 + 4 and all(0 <= s <= 1 for s in scores.values())
    held = [i for i in range(600) if i % 5 == 0]
    assert np.mean([(scores[i] > 0.5) == (i % 3 != 0) for i in held]) > 0.97


def test_quality_without_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.quality_scores(documents((1, "a"), (2, None)), none, F.lit(True)).collect()] == [0.5, 0.5]


def test_trees_follow_their_arrays():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    trees = quality.grow(x, ((x[:, 2] > 0) ^ (x[:, 5] > 0.3)).astype(float), trees=5)

    def walk(row):
        total = trees.start
        for f, t, leaves in zip(trees.features, trees.thresholds, trees.leaves, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            total += leaves[k - len(f)]
        return 1 / (1 + math.exp(-total))

    np.testing.assert_allclose(trees.predict(x[:50]), [walk(r) for r in x[:50]])


def brute_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment():
    random.seed(10)
    for _ in range(200):
        a = [random.choice("abcdefghijklmnop") for _ in range(random.randrange(25))]
        b = [random.choice("abcdefghijklmnop") for _ in range(random.randrange(25))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) <= brute_lcs(a, b)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
        values = [random.randrange(30) for _ in range(20)]
        found = licenses.longest_increasing(values)
        taken = [values[i] for i in found]
        assert taken == sorted(set(taken)) and len(found) == brute_lcs(values, sorted(set(values)))
    assert licenses.align(list("abc"), list("abc")) == [(0, 0), (1, 1), (2, 2)]


def test_license_scan(documents):
    mit, cc = licenses.TEMPLATES["MIT"].text, licenses.TEMPLATES["CC-BY-NC-4.0"].text
    text = licenses.TEMPLATES["MIT-text"].text
    broken = text.replace("free of charge", "gratis").replace("merge, ", "")
    rows = [
        (1, f"some words. {mit} more of the words"), (2, f"{cc}\n{mit}"), (3, None), (4, ""), (5, "the license of the mit"),
        (6, f"the the {broken} the end"), (7, f"{mit} x {mit}"), (8, "word " * 40_000 + mit), (9, mit.upper()), (9, mit.upper()),
        (None, mit), (10, " ".join(f"{w} far" + " away" * 9 for w in mit.split())),
    ]
    got = sorted((str(r["id"]), r["license"], round(r["coverage"], 2), r["start_word"], r["end_word"]) for r in licenses.scan(documents(*rows)).collect())
    n = len(licenses.words_of(text))
    assert [g for g in got if g[0] != "6"] == [
        ("1", "MIT", 1.0, 2, 7), ("2", "CC-BY-NC-4.0", 1.0, 0, 5), ("2", "MIT", 1.0, 5, 10), ("7", "MIT", 1.0, 0, 5),
        ("8", "MIT", 1.0, 40000, 40005), ("9", "MIT", 1.0, 0, 5), ("9", "MIT", 1.0, 0, 5), ("None", "MIT", 1.0, 0, 5),
    ]
    assert [g[:3] for g in got if g[0] == "6"] == [("6", "MIT-text", round((n - 4) / n, 2))]
    assert licenses.scan(documents((1, mit)).limit(0)).collect() == []


def test_licenses_that_differ_in_a_word(documents):
    rows = [
        (1, "This work is licensed under the GNU General Public License, version 2."), (2, "Licensed under the Apache License, Version 1.1."),
        (3, "Licensed under CC BY-NC 3.0."), (4, "Licensed under CC BY-SA 4.0."), (5, "Released under the BSD License."),
        (6, "Released under the ISC License."), (7, "This work is licensed under the GNU Lesser General Public License, version 3."),
        (8, licenses.TEMPLATES["BSD-2-Clause-text"].text), (9, licenses.TEMPLATES["BSD-3-Clause-text"].text),
        (10, licenses.TEMPLATES["LGPL-3.0-header"].text), (11, licenses.TEMPLATES["GPL-2.0-header"].text),
        (12, "Licensed under CC BY-NC 3.0. Some more. Licensed under CC BY-NC 4.0."), (13, "Licensed under the MIT and other licenses"),
    ]
    got = sorted((r["id"], r["license"]) for r in licenses.scan(documents(*rows)).collect())
    assert got == [
        (1, "GPL-2.0"), (2, "Apache-1.1"), (4, "CC-BY-SA-4.0"), (6, "ISC"), (7, "LGPL-3.0"), (8, "BSD-2-Clause-text"),
        (9, "BSD-3-Clause-text"), (10, "LGPL-3.0-header"), (11, "GPL-2.0-header"), (12, "CC-BY-NC-4.0"),
    ]
    with pytest.raises(ValueError, match="deciding"):
        licenses.scan(documents(*rows), {"a": licenses.Notice("some words", ("other words",))})
    plain = licenses.scan(documents((1, "so some words here")), {"a": "some words", "none": ""})
    assert [(r["license"], r["start_word"]) for r in plain.collect()] == [("a", 1)]


def brute_license(words, template):
    """The largest coverage of a template by a stretch of a text, by the longest common subsequence of every stretch that holds the phrases."""
    best = 0
    for start in range(len(words)):
        for end in range(start + template.needed, min(len(words), start + template.reach) + 1):
            part = words[start:end]
            if not all(next(licenses.places_of(p, part), None) is not None for _, p in template.fixed):
                continue
            if part[0] in template.words and part[-1] in template.words:
                common = brute_lcs(part, template.words)
                if common >= template.needed and common >= licenses.DENSITY * len(part):
                    best = max(best, common)
    return best / len(template.words)


def test_license_scan_by_brute_force():
    random.seed(12)
    names = ["MIT", "GPL-3.0", "CC-BY-NC-4.0", "MPL-2.0", "Apache-2.0"]
    own = {"plain": licenses.Notice("you may copy and share this text with all who keep this line in it")}
    known = [licenses.Template(n, licenses.TEMPLATES[n], 0.8) for n in names] + [licenses.Template("plain", own["plain"], 0.8)]
    hits = 0
    for _ in range(60):
        words = []
        for _ in range(random.randrange(1, 4)):
            notice = list(random.choice(known).words)
            for _ in range(random.randrange(3)):
                place = random.randrange(len(notice))
                notice[place : place + random.randrange(2)] = [f"x{random.randrange(99)}"]
            words += [f"w{random.randrange(99)}" for _ in range(random.randrange(9))] + notice
        for template in known:
            found, exact = template.best(words), brute_license(words, template)
            assert (found[0] if found else 0) == pytest.approx(exact), (template.name, words)
            hits += exact > 0
    assert hits > 30


def test_license_scan_is_linear():
    """Windows that are aligned grow with the words, also where the template's words repeat all the time."""
    template = licenses.Template("MIT-text", licenses.TEMPLATES["MIT-text"], 0.8)
    aligned = [sum(1 for _ in template.in_windows(template.words * n)) for n in (10, 20, 40)]
    assert aligned[1] <= 2 * aligned[0] + 4 and aligned[2] <= 2 * aligned[1] + 4 and aligned[2] <= 200
    phrase = licenses.Template("MIT", licenses.TEMPLATES["MIT"], 0.8)
    assert sum(1 for _ in phrase.around_phrases(phrase.words * 1000)) == 2000
