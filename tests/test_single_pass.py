"""Jobs that read their input once: parsing, strictness, named outputs, and counts taken while writing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from careerloom import operators as op
from careerloom import plans, sources
from careerloom.plans.files import _parsed

GOOD = '{"first-name":"A","skills":["x"],"positions":[{"start-date":"2000","is-current":true}]}'
BAD_YEAR = '{"first-name":"B","positions":[{"start-date":"abc"}]}'
ARRAYS = [
    f"[{GOOD}]", f"[{GOOD},null,{BAD_YEAR}]", "[]", "[{", GOOD, "", " \t", "null", "[null]", "text", '[{"first-name":5}]',
    "[{'first-name':'q', skills: ['s']}]", '[{"skills":"text"}]', '[{"first-name":{"a":1}}] ', f"[{GOOD}] x", f"[{GOOD}],[{GOOD}]",
    '[{"positions":[{"is-current":"true","title":7}]}]', '[{"positions":[5]}]', "[5]", '[{"relevantExperience":1.5}]',
    '[{"relevantExperience":"7"}]', '[{"num-connections":["1"]}]', '[{"skills":[{"a":1}]}]', '[{"skills":null,"industry":null}]',
]
OBJECTS = [
    GOOD, BAD_YEAR, "{}", '{"skills":[', f"[{GOOD}]", "", "null", f"{GOOD} x", f"{GOOD},{GOOD}", '{"industry":[]}', '{"a":1} }',
    '{first-name:"x"}', '{"positions":{"title":"t"}}', '{"positions":[null,{"title":null}]}',
]


def frame(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")


@pytest.mark.parametrize("layout, lines", [("array", ARRAYS), ("object", OBJECTS)])
@pytest.mark.parametrize("columns", [None, ["industry"], ["skills", "positions"]])
def test_one_pass_gives_what_two_gave(spark, layout, lines, columns):
    df = frame(spark, lines)
    parsed = sources.parse_lines(df, layout=layout, columns=columns)
    reader = sources.read_profile_arrays if layout == "array" else sources.read_profile_objects
    expected = reader(df, columns=columns)
    assert rows(sources.profiles_of(parsed)) == rows(expected.select(*[c for c in expected.columns if c != "value"]))
    assert rows(sources.rejects_of(parsed)) == rows(sources.rejected_lines(df, layout=layout))


def reasons(spark, lines, layout):
    return {r["line"]: r["reason"] for r in sources.rejected_lines(frame(spark, lines), layout=layout, strict=True).collect()}


def test_strict_reasons(spark):
    assert reasons(spark, ARRAYS, "array") == {
        f"[{GOOD},null,{BAD_YEAR}]": "bad_year", "[{": "malformed", GOOD: "other_layout", "text": "other_layout",
        '[{"skills":"text"}]': "wrong_type", '[{"first-name":{"a":1}}] ': "wrong_type", f"[{GOOD}] x": "trailing_text",
        f"[{GOOD}],[{GOOD}]": "trailing_text", '[{"positions":[5]}]': "wrong_type", "[5]": "wrong_type",
        '[{"relevantExperience":1.5}]': "wrong_type", '[{"num-connections":["1"]}]': "wrong_type",
        '[{"skills":[{"a":1}]}]': "wrong_type",
    }
    assert reasons(spark, OBJECTS, "object") == {
        BAD_YEAR: "bad_year", '{"skills":[': "malformed", f"[{GOOD}]": "other_layout", f"{GOOD} x": "trailing_text",
        f"{GOOD},{GOOD}": "trailing_text", '{"industry":[]}': "wrong_type", '{"a":1} }': "trailing_text",
        '{"positions":{"title":"t"}}': "wrong_type",
    }


def test_strict_keeps_whole_lines_only(spark):
    df = frame(spark, ARRAYS)
    strict, loose = (sources.read_profile_arrays(df, strict=s).drop("positions", "relevant_experience") for s in (True, False))
    dropped = [i for i, line in enumerate(ARRAYS) if reasons(spark, [line], "array").get(line) not in (None, "bad_year")]
    assert rows(strict) == rows(loose.filter(~F.col("line_no").isin(dropped)))
    current = sources.read_profile_arrays(df, strict=True).filter("line_no = 16").first()["positions"][0]
    assert current["is_current"] is True and current["title"] == "7"
    # A narrow reader drops the same lines as a wide one.
    narrow = sources.read_profile_arrays(df, columns=["industry"], strict=True)
    assert rows(narrow.select("line_no")) == rows(strict.select("line_no"))
    objects = sources.read_profile_objects(frame(spark, OBJECTS), strict=True)
    assert [r["value"] for r in objects.orderBy("line_no").collect()] == [GOOD, BAD_YEAR, "{}", OBJECTS[11], OBJECTS[13]]


def test_jobs_parse_their_text_once(spark, tmp_path):
    (tmp_path / "raw").write_text("\n".join(ARRAYS))
    profiles = _parsed(spark.read.text(str(tmp_path / "raw")), str(tmp_path / "out"))
    plan = profiles._jdf.queryExecution().toString()
    assert "parquet" in plan.lower() and "Scan text" not in plan and "from_json" not in plan
    lines = spark.read.text(str(tmp_path / "raw"))
    assert profiles.count() == sources.read_profile_arrays(lines).count()
    rejected = spark.read.json(str(tmp_path / "out_rejected")).select("line", "reason")
    assert rows(rejected) == rows(sources.rejected_lines(lines))
    (tmp_path / "places.csv").write_text("France,Ile,Paris")
    plans.headcount_files(spark, str(tmp_path / "raw"), str(tmp_path / "places.csv"), 2000, str(tmp_path / "h"), strict=True)
    assert spark.read.json(str(tmp_path / "h_rejected")).count() > 0


def outputs(spark, path, *names):
    return {n: sorted(r[0] for r in spark.read.text(f"{path}/{n}").collect()) for n in names}


def test_named_outputs_in_one_job(spark, tmp_path):
    path, context = str(tmp_path / "out"), spark.sparkContext
    frames = {"big": spark.range(1000).selectExpr("cast(id AS string) AS value"), "small": spark.sql("SELECT 'x' AS value")}
    frames["none"] = frames["small"].filter("value = 'y'")
    before = max([0, *context.statusTracker().getJobIdsForGroup(None)])
    sources.write_named_outputs(frames, path)
    jobs = [j for j in context.statusTracker().getJobIdsForGroup(None) if j > before]
    assert len(jobs) <= 2  # the stage before the rebalance, and the write
    want = {"big": sorted(map(str, range(1000))), "small": ["x"], "none": []}
    assert outputs(spark, path, *frames) == want
    assert sorted(p.name for p in Path(path).iterdir()) == ["big", "none", "small"]
    sources.write_named_outputs(frames, path)  # replaces
    assert outputs(spark, path, *frames) == want
    sources.write_named_outputs({"small": frames["small"]}, path, mode="append")
    assert outputs(spark, path, "small") == {"small": ["x", "x"]}
    sources.write_named_outputs({"small": frames["big"]}, path, mode="ignore")
    assert outputs(spark, path, "small") == {"small": ["x", "x"]}
    with pytest.raises(FileExistsError):
        sources.write_named_outputs(frames, path, mode="error")
    # Frames with different columns are written one by one.
    mixed = {"a": spark.range(2), "b": spark.sql("SELECT 'z' AS value")}
    sources.write_named_outputs(mixed, path, format="parquet")
    assert spark.read.parquet(f"{path}/a").count() == 2 and spark.read.parquet(f"{path}/b").first()[0] == "z"


def test_observed_counts_equal_the_queries(spark, profiles, tmp_path):
    df = profiles(
        *[
            {"industry": [None, "null", "LAW", " "][i % 4], "positions": [(str(1990 + i), str(1992 + i % 3))][: i % 3]}
            for i in range(24)
        ]
    ).withColumnRenamed("industry", "sector")
    counted, seen = sources.observed(df, **op.null_sector_metrics())
    sources.written_table(counted, str(tmp_path / "t"))
    found = sources.observed_row(spark, seen, "n_rows bigint, n_profiles bigint")
    assert rows(found) == rows(op.null_sector_count(df)) and found.first()["n_rows"] > 0
    store = op.year_store_rows(df, sector_col="sector")
    seen = sources.year_store_write(store, str(tmp_path / "store"))
    assert seen.get["n_rows"] == op.year_store_row_count(store).first()["n_rows"] > 0
    empty = sources.year_store_write(store.filter("false"), str(tmp_path / "store"), load="none")
    assert empty.get["n_rows"] == 0


RETRY = """
import sys
from pyspark.sql import SparkSession, functions as F
from careerloom import sources
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()

def fail_first(batches):
    from pyspark import TaskContext
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 1000, 1, 4).mapInArrow(fail_first, "id long").selectExpr("id", "cast(id % 3 AS string) AS sector", "cast(id % 5 AS int) AS year")
counted, seen = sources.observed(rows, n=F.count("*"), total=F.sum("id"))
sources.written_table(counted, sys.argv[1] + "/t")
print("SEEN", seen.get["n"], seen.get["total"], sources.year_store_write(rows, sys.argv[1] + "/s").get["n_rows"])
"""


def test_observed_counts_survive_tasks_that_run_again(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    run = subprocess.run(
        [sys.executable, "-c", RETRY, str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=120, check=False
    )
    assert "SEEN 1000 499500 1000" in run.stdout, run.stderr[-2000:]
