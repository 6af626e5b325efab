"""JSON lines, lookups, sinks and stores."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from careerloom import operators as op
from careerloom import sources

WHOLE = {
    "skills": ["a", "b"],
    "positions": [{"title": "t", "start-date": "2000-01-01", "is-current": True, "company-name": "c"}],
    "public-profile-url": "/pub",
    "location": "Greater X Area",
    "num-connections": "500+",
    "first-name": "F",
    "last-name": "L",
    "industry": "I",
}


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def test_arrays(spark):
    df = sources.read_profile_arrays(
        lines(spark, json.dumps([WHOLE, {"first-name": "G"}]), "", " \t", "null", None, "[{", "[]",
              json.dumps(WHOLE), "[null, {'first-name':'H'}]", "[{first-name:'X'}]"[:1] + "{industry:'Q'}]",
              '[{"first-name":"K","num-connections":7,"skills":null,"positions":null}]')
    )
    got = {r["first_name"]: r for r in df.collect()}
    assert set(got) == {"F", "G", "H", None, "K"}
    whole = got["F"]
    assert whole["skills"] == ["a", "b"] and whole["num_connections"] == "500+" and whole["industry"] == "I"
    assert whole["positions"][0].asDict() == {
        "summary": None, "title": "t", "start_date": "2000-01-01", "end_date": None,
        "is_current": True, "company_name": "c",
    }
    assert got["G"]["skills"] == [] and got["G"]["positions"] == []
    assert got["K"]["skills"] == [] and got["K"]["positions"] == [] and got["K"]["num_connections"] == "7"
    assert got[None]["industry"] == "Q"


def test_wrong_types_keep_the_rest(spark):
    line = '[{"first-name":"A","skills":"text","positions":[{"title":"t","is-current":"true"}]}]'
    row = sources.read_profile_arrays(lines(spark, line)).first()
    assert row["first_name"] == "A" and row["skills"] == []
    assert row["positions"][0]["title"] == "t" and row["positions"][0]["is_current"] is None


def test_objects_keep_the_raw_line(spark):
    good = json.dumps(WHOLE | {"relevantExperience": 3})
    df = sources.read_profile_objects(lines(spark, good, "{}", "null", "", good[:-4], f"[{good}]"))
    got = rows(df.select("n", "value", "first_name", "relevant_experience"))
    assert got == [(0, good, "F", 3), (1, "{}", None, None)]


def test_only_needed_fields_are_parsed(spark):
    df = sources.read_profile_arrays(lines(spark, json.dumps([WHOLE])), columns=["industry", "skills"])
    assert df.columns == ["n", "skills", "industry"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "company-name" not in plan


def test_rejected_lines(spark):
    bad_year = json.dumps([{"positions": [{"start-date": "n/a"}]}])
    fine = json.dumps([WHOLE])
    values = ("[{", bad_year, fine, json.dumps(WHOLE), " ", "null", None, "junk")
    got = rows(sources.rejected_lines(lines(spark, *values)))
    assert got == sorted(
        [("[{", "malformed"), (bad_year, "bad_year"), (json.dumps(WHOLE), "other_layout"), ("junk", "other_layout")],
        key=repr,
    )
    objects = sources.rejected_lines(lines(spark, json.dumps(WHOLE), "{", fine), layout="object")
    assert rows(objects.select("reason")) == [("malformed",), ("other_layout",)]


def test_profile_ids_are_unique(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    (tmp_path / "b.txt").write_text("z\n")
    df = sources.with_profile_id(spark.read.text(str(tmp_path)))
    assert df.select("pid").distinct().count() == 3


def lookup_lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line_no int, line string")


def test_lookup_pairs_last_line_wins(spark):
    df = sources.lookup_pairs(lookup_lines(spark, "a,1", "b,2,9", "a,3", "c", "d,", "b,2"))
    assert rows(df) == [("a", "3"), ("b", "2")]


def test_lookup_lists(spark):
    df = sources.lookup_lists(lookup_lines(spark, "a,1", "b", "a,3,4,,"))
    assert rows(df) == [("a", ["3", "4"]), ("b", [])]


def test_read_lines_keeps_file_order(spark, tmp_path):
    (tmp_path / "l.csv").write_text("a,1\na,2\nb,1\n")
    assert rows(sources.lookup_pairs(sources.read_lines(spark, str(tmp_path)))) == [("a", "2"), ("b", "1")]


def test_place_lookup(spark):
    df = sources.place_lookup(
        lookup_lines(spark, "Georgia,,Tbilisi", "USA,Georgia,Atlanta", "X,Y", "Peru,Lima,Lima", "Chad,Mali,Mali")
    )
    assert dict(rows(df)) == {
        "Georgia": "USA", "Tbilisi": "Georgia", "USA": "USA", "Atlanta": "USA",
        "Peru": "Peru", "Lima": "Peru", "Chad": "Chad", "Mali": "Chad",
    }


def test_parse_tag_line(spark):
    df = sources.parse_tag_line(lookup_lines(spark, "t,a,b", "alone", "u,"))
    assert rows(df.select("tag", "industries")) == [("alone", ["alone"]), ("t", ["a", "b"]), ("u", [""])]


def test_key_list_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t", ["b", "a"]), ("u", [])], "tag string, vals array<string>")
    path = str(tmp_path / "out")
    sources.write_key_list(df, path, "tag", "vals")
    assert rows(spark.read.text(path)) == [("t,b,a",), ("u",)]


def test_named_outputs_and_matching_files(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "value string")
    sources.write_named_outputs({"one": df, "two": df.union(df)}, str(tmp_path / "o"))
    assert spark.read.text(str(tmp_path / "o" / "two")).count() == 2
    for name in ("tag-1.txt", "tag-2.txt", "other.txt", "t[g.txt"):
        (tmp_path / name).write_text(name + "\n")
    matched = sources.read_matching_files(spark, str(tmp_path), "tag-")
    assert rows(matched) == [("tag-1.txt",), ("tag-2.txt",)]
    assert rows(sources.read_matching_files(spark, str(tmp_path), "t[g")) == [("t[g.txt",)]
    first = sources.read_matching_files(spark, str(tmp_path), "tag", first_only=True)
    assert rows(first) == [("tag-1.txt",)]
    with pytest.raises(FileNotFoundError):
        sources.read_matching_files(spark, str(tmp_path), "absent", first_only=True)


def test_profile_json_leaves_out_nulls(spark, profiles):
    df = profiles({"first_name": "A", "skills": ["x"], "positions": [("2000", None)]})
    line = json.loads(sources.profile_json_lines(df).first()["value"])
    assert line["first-name"] == "A" and "last-name" not in line
    assert line["positions"] == [
        {"summary": "s", "title": "t", "start-date": "2000", "is-current": False, "company-name": "c"}
    ]


def test_scratch_folder_is_shared():
    class Session:
        def __init__(self, values):
            self.conf = values

    both = {"spark.checkpoint.dir": "s3a://bucket/x/", "spark.sql.warehouse.dir": "hdfs://h/w"}
    assert sources.scratch_folder(Session(both)).startswith("s3a://bucket/x/careerloom-")
    del both["spark.checkpoint.dir"]
    assert sources.scratch_folder(Session(both)).startswith("hdfs://h/w/careerloom-")


def test_lines_of_several_files_follow_their_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,a\n")
    (tmp_path / "b.csv").write_text("k,b\n" + "x,1\n" * 5000)
    assert dict(rows(sources.lookup_pairs(sources.read_lines(spark, str(tmp_path)))))["k"] == "b"


def test_a_line_holds_one_object(spark):
    one, two, more = json.dumps(WHOLE), json.dumps(WHOLE) + "," + json.dumps(WHOLE), json.dumps(WHOLE) + "]]x"
    df = lines(spark, one, two, more)
    assert sources.read_profile_objects(df).count() == 1
    assert rows(sources.rejected_lines(df, layout="object")) == sorted([(two, "malformed"), (more, "malformed")], key=repr)


def test_matching_finds_named_outputs(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "value string")
    sources.write_named_outputs({"toptags": df, "tagsector": df.union(df)}, str(tmp_path))
    assert sources.read_matching_files(spark, str(tmp_path), "toptags").count() == 1
    assert sources.read_matching_files(spark, str(tmp_path), "tag", first_only=True).count() == 2
    assert sources.read_named_lines(spark, str(tmp_path), "toptags").count() == 1
    assert sources.read_named_lines(spark, str(tmp_path / "tagsector"), "tagsector").count() == 2


def store_rows(spark, profiles):
    df = profiles(
        {"pid": 1, "industry": "BANKING", "location": "A", "positions": [("2000", "2001"), ("2003", "2003")]},
        {"pid": 2, "industry": None, "location": "A", "positions": [("2000", "2000")]},
        {"pid": 3, "industry": "LEGAL", "location": None, "positions": [("2000", "2000")]},
        {"pid": 4, "industry": "LEGAL", "location": "B"},
    )
    return op.year_store_rows(df)


def test_year_store(spark, profiles, tmp_path):
    path = str(tmp_path / "years")
    stored = store_rows(spark, profiles)
    sources.year_store_write(stored, path, "one")
    sources.year_store_write(stored, path, "one")  # loading again replaces, never doubles
    back = sources.year_store_read(spark, path)
    assert back.count() == stored.count() == 7
    sources.year_store_write(stored.filter("year = 2000"), path, "two")  # another load is added
    both = sources.year_store_read(spark, path)
    assert rows(both.groupBy("load").count()) == [("one", 7), ("two", stored.filter("year = 2000").count())]
    sources.year_store_write(stored.limit(0), path, "two")
    assert sources.year_store_read(spark, path).count() == 7
    scan = sources.year_store_scan(back, 2002)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    row = scan.first()
    assert (row["pid"], row["industry"], row["positions"][0]["start_date"], row["positions"][0]["title"]) == (
        1, "BANKING", "2002", "",
    )
    assert rows(sources.year_store_scan(back, 2000).select("pid")) == [(1,)]


def test_model_store_reads_wanted_sectors(spark, tmp_path):
    models = spark.createDataFrame([("A", 2000, 1), ("B", 2000, 2)], "sector string, model_year int, n_rows bigint")
    path = str(tmp_path / "m")
    sources.model_store(models, path)
    only = sources.model_load(spark, path, ["A"])
    assert rows(only.select("sector", "n_rows")) == [("A", 1)]
    assert "PartitionFilters: [" in only._jdf.queryExecution().executedPlan().toString()
    assert sources.model_load(spark, path).count() == 2
    sources.model_store(models.limit(0), path)
    assert sources.model_load(spark, path, ["A"]).count() == 0


def test_read_then_write_json_is_stable(spark):
    df = sources.read_profile_arrays(lines(spark, json.dumps([WHOLE]))).drop("n")
    again = sources.read_profile_objects(sources.profile_json_lines(df)).drop("value")
    assert rows(again.select(*df.columns).withColumn("positions", F.to_json("positions"))) == rows(
        df.withColumn("positions", F.to_json("positions"))
    )


def rows_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_year_store_reads_a_range_of_keys(spark, tmp_path):
    """Of a year's file, only the pages that hold the sector and the ids are read."""
    path, n = str(tmp_path / "years"), 400_000
    stored = spark.range(n).selectExpr(
        "id AS pid", "concat('S', lpad(pmod(hash(id), 10), 2, '0')) AS sector", "concat('first', id) AS first_name",
        "'l' AS last_name", "'1' AS num_connections", "'x' AS location", "0 AS rel_experience",
        "'t' AS last_title", "'c' AS last_company", "2000 AS year",
    )
    sources.year_store_write(stored, path)
    store = sources.year_store_read(spark, path)
    wanted = stored.filter("sector = 'S03'")
    one = sources.year_store_keys(store, 2000, "S03")
    assert rows(one.select("pid")) == rows(wanted.select("pid"))
    assert rows_read(one.select("pid", "sector")) < 0.3 * n
    some = sources.year_store_keys(store, 2000, "S03", 1000, 2000)
    assert rows(some.select("pid")) == rows(wanted.filter("pid >= 1000 AND pid < 2000").select("pid"))
    assert rows_read(some.select("pid", "sector")) < 0.15 * n
    # A sector between the others passes the statistics, but not the bloom filter.
    assert rows_read(sources.year_store_keys(store, 2000, "S035").select("pid", "sector")) == 0
    assert sources.year_store_keys(store, 1999, "S03").count() == 0
    assert sources.year_store_scan(store, 2000, "S03").count() == wanted.count()
    with pytest.raises(ValueError):
        sources.year_store_keys(store, 2000, first_id=1)
