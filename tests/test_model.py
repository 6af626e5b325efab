"""Learning, scoring, voting and evaluation, against a plain-Python naive Bayes."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from careerloom import operators as op
from careerloom import plans, sources
from careerloom.schema import SECTORS

FEATURES = (
    "pid int, sector string, year int, connections int, experience int, "
    + "".join(f"tag_{i} int, " for i in range(1, 6))
    + "label string"
)


def feature(pid, sector="LEGAL", year=2000, connections=0, experience=0, flags=(None,) * 5, label="NO"):
    return (pid, sector, year, connections, experience, *flags, label)


def frame(spark, data):
    return spark.createDataFrame(data, FEATURES)


def mean_sd(values):
    mean = sum(values) / len(values)
    return mean, max(math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)), 1 / 6)


def log_likelihood(group, row):
    n = len(group)
    total = math.log(n + 1) + math.log((n + 1) / (n + len(SECTORS)))
    for column in (3, 4):
        mean, sd = mean_sd([g[column] for g in group])
        total += -math.log(sd) - 0.5 * ((row[column] - mean) / sd) ** 2
    for column in range(5, 10):
        if row[column] is not None:
            k = sum(g[column] for g in group)
            total += math.log(((k if row[column] else n - k) + 1) / (n + 2))
    return total


def brute_votes(train, test):
    models = defaultdict(lambda: defaultdict(list))
    for row in train:
        if row[10] and row[1] in SECTORS:
            models[(row[1], row[2])][row[10]].append(row)
    votes = {}
    for row in test:
        votes[row[0]] = 0
        for (sector, _), classes in models.items():
            if sector != row[1]:
                continue
            score = {c: log_likelihood(g, row) for c, g in classes.items()}
            no = score.get("NO", -math.inf) - score.get("YES", -math.inf) > 1e-9
            votes[row[0]] += 1 if no else -1
    return votes


def sample(n):
    """People of three sectors over five years; one sector holds most of them."""
    data = []
    for i in range(n):
        sector = "LEGAL" if i % 5 < 3 else ["ENERGY", "NOWHERE"][i % 2]
        flags = tuple((i // (j + 1)) % 2 if sector == "LEGAL" or j < 2 else None for j in range(5))
        label = [None, "YES", "NO", "NO", "YES", "NO", "NO"][(i * 7 // 3) % 7]
        data.append(feature(i, sector, 1998 + i % 5, (i * 37) % 501, (i * 11) % 13, flags, label))
    return data


def test_votes_match_brute_force(spark):
    data = sample(600)
    train, test = op.split_by_year(frame(spark, data), 2000)
    models = op.train_sector_year_nb(train)
    voted = op.vote(test, op.sector_models(models))
    expected = brute_votes([r for r in data if r[2] != 2000], [r for r in data if r[2] == 2000])
    assert {r["pid"]: r["votes"] for r in voted.collect()} == expected
    assert set(expected.values()) - {0}
    single = op.score_nb(test, op.sector_models(models))
    summed = single.groupBy("pid").agg(F.sum(F.when(F.col("predicted") == "NO", 1).otherwise(-1)))
    assert {k: v for k, v in rows(summed)} == {k: v for k, v in expected.items() if k in dict(rows(summed))}
    assert {r["sector"] for r in models.collect()} == {"LEGAL", "ENERGY"}


def test_training_years(spark):
    df = frame(spark, [feature(i, year=1999 + i) for i in range(4)])
    train, test = op.split_by_year(df, 2000)
    assert rows(train.select("year")) == [(1999,), (2001,), (2002,)] and test.count() == 1
    before, _ = op.split_by_year(df, 2000, train_before_only=True)
    assert rows(before.select("year")) == [(1999,)]


def predict_one(spark, train, **test):
    models = op.sector_models(op.train_sector_year_nb(frame(spark, train)))
    row = op.vote(frame(spark, [feature(99, **test)]), models).first()
    return row["votes"], row["predicted"]


def test_class_without_rows_cannot_win(spark):
    only_no = [feature(1, year=1999), feature(2, year=1998, label="YES")]
    assert predict_one(spark, only_no[:1]) == (1, "NO")
    assert predict_one(spark, only_no[1:]) == (-1, "YES")
    assert predict_one(spark, only_no) == (0, "YES")


def test_no_model_and_exact_tie_are_yes(spark):
    assert predict_one(spark, [feature(1, sector="ENERGY", year=1999)]) == (0, "YES")
    twins = [feature(1, year=1999), feature(2, year=1999, label="YES")]
    assert predict_one(spark, twins) == (-1, "YES")


def test_confusion_and_summary(spark):
    data = [("A", "YES", "YES", 1), ("A", "YES", "NO", 2), ("A", "NO", "YES", 3), ("A", "NO", "NO", 4),
            ("A", None, "NO", 5), ("B", None, "YES", 1), (None, "NO", "NO", 9)]
    df = spark.createDataFrame(data, "sector string, label string, predicted string, n int")
    known = df.filter("sector IS NOT NULL")
    as_dict = op.confusion_counts(known, weight_col="n").first().asDict()
    assert as_dict == {"true_positive": 4, "true_negative": 1, "false_positive": 2, "false_negative": 3}
    flipped = op.confusion_counts(known, positive="YES", weight_col="n").first().asDict()
    assert flipped == {"true_positive": 1, "true_negative": 4, "false_positive": 3, "false_negative": 2}
    assert rows(op.sector_prediction_summary(df, weight_col="n")) == [("A", 15, 7, 6), ("B", 1, 0, 0)]
    assert rows(op.sector_prediction_summary(df)) == [("A", 5, 2, 2), ("B", 1, 0, 0)]
    assert rows(op.sector_prediction_summary(df, positive="YES")) == [("A", 5, 2, 2), ("B", 1, 0, 0)]


def test_features(spark, profiles):
    tags = spark.createDataFrame([("LEGAL", ["C", "Law"]), ("ENERGY", [])], "sector string, tags array<string>")
    df = profiles(
        {"pid": 1, "skills": ["C++", None], "num_connections": "500+", "positions": [("2000", "2000"), ("2000", "2001")]},
        {"pid": 2, "skills": ["Law", "C"], "num_connections": None, "positions": [("2000", "2000"), ("2002", "2002")]},
        {"pid": 3, "skills": ["Law"], "positions": [("2000", "2000")]},
    ).withColumn("sector", F.expr("element_at(array('LEGAL', 'LEGAL', 'ENERGY'), CAST(pid AS INT))"))
    panel = op.profile_year_panel(df)
    got = rows(op.feature_rows(panel, tags, k=3))
    assert got == [
        (1, "LEGAL", 2000, 500, 0, 0, 0, None, "YES"), (1, "LEGAL", 2001, 500, 1, 0, 0, None, "NO"),
        (2, "LEGAL", 2000, 0, 0, 1, 1, None, "NO"), (2, "LEGAL", 2001, 0, 1, 1, 1, None, None),
        (2, "LEGAL", 2002, 0, 2, 1, 1, None, "NO"), (3, "ENERGY", 2000, 1, 0, None, None, None, "NO"),
    ]
    cleaned = op.feature_rows(panel, tags, k=2, normalize=True).filter("pid = 1 AND year = 2000")
    assert cleaned.first()["tag_1"] == 1
    early = op.feature_rows(op.profile_year_panel(op.feature_columns(df, tags, k=3)), tags, k=3)
    assert rows(early) == got
    without = op.attach_top_tags(df.withColumn("sector", F.lit("NEW")), tags)
    assert without.first()["tags"] == []


@pytest.mark.parametrize("train_before_only", [False, True])
def test_evidence_gives_the_same_summary_as_rows(spark, profiles, train_before_only):
    """The compact path of the whole job agrees with scoring every row, with one dominant sector."""
    people = profiles(
        *[
            {
                "pid": i,
                "batch": i % 3,
                "industry": "i1" if i % 3 else ["i2", None, "i3"][i % 7 % 3],
                "skills": [f"s{i % 4}", f"s{i % 5}"],
                "num_connections": f"{(i * 37) % 500}+",
                "positions": [
                    (str(1996 + i % 5), str(1998 + i % 4)), (str(1998 + i % 3), None), ("2000/1", "2000-5"),
                ][: 1 + i % 2 + (i % 7 > 3)],
            }
            for i in range(240)
        ]
    )
    lookup = spark.createDataFrame([("i1", "LEGAL"), ("i2", "ENERGY"), ("i3", "NOWHERE")], "industry string, sector string")
    years = {"start_year": 1996, "end_year": 2001}
    whole = plans.evaluate_held_out_year(
        people, lookup, **years, test_year=2000, train_before_only=train_before_only
    )
    tag_sector, top_tags = plans.tag_tables(people, lookup)
    assigned = op.require_sector(op.assign_sector(people, lookup, tag_sector))
    features = op.feature_rows(op.profile_year_panel(assigned, **years), top_tags)
    train, test = op.split_by_year(features, 2000, train_before_only)
    voted = op.vote(test, op.sector_models(op.train_sector_year_nb(train)))
    assert rows(whole) == rows(op.sector_prediction_summary(voted))
    assert len(rows(whole)) == 3
    assert any(0 < r["predict_left"] < r["test_size"] for r in whole.collect())


def test_models_of_batches_merge_to_those_of_all(spark, tmp_path):
    rows_ = [
        ("LAW", 2000 + i % 2, float(i * i % 97), float(i % 7), i % 2, (i // 2) % 2, None, None, None, "YES" if i % 3 else "NO")
        for i in range(60)
    ] + [("RETAIL_WHOLESALE", 2001, 4.0, 1.0, 1, 0, None, None, None, "NO")]
    names = ["sector", "year", "connections", "experience", *op.tag_columns(5), "label"]
    kinds = ["string", "int", "double", "double", *["int"] * 5, "string"]
    df = spark.createDataFrame(rows_, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    vocabulary = ["LAW", "RETAIL_WHOLESALE"]

    def trained(part):
        return op.train_sector_year_nb(df.filter(part), sectors=vocabulary)

    def rounded(models):
        return sorted(
            tuple(round(v, 9) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v for v in r)
            for r in models.select("sector", "model_year", "label", "n_rows", "mean_connections", "sd_connections", "mean_experience", "sd_experience", "tag_counts").collect()
        )

    parts = [trained(f"connections % 4 = {i}") for i in range(4)] + [trained("false")]
    assert rounded(op.merge_models(*parts)) == rounded(trained("true")) == rounded(op.merge_models(*parts[::-1]))
    assert rounded(op.merge_models(parts[0])) == rounded(parts[0])
    # A store is updated from itself; sectors that the update lacks stay.
    path = str(tmp_path / "models")
    sources.model_store(trained("connections < 30"), path)
    update = trained("connections >= 30 AND sector = 'LAW'")
    stored = sources.model_load(spark, path, ["LAW"])
    sources.model_replace(op.merge_models(stored, update), path)
    assert rounded(sources.model_load(spark, path)) == rounded(trained("true"))
