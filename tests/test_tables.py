"""The profiles hold all orders and line items of the given tables."""

from __future__ import annotations

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F

from careerloom import operators as op
from careerloom.functions import date_year
from careerloom.plans import jobs, tables
from careerloom.plans.tables import TEST_YEAR
from careerloom.schema import SECTORS
from registry.queries import QUERIES, YEARS, Inputs


@pytest.fixture(scope="module")
def everyone(spark):
    return tables.profiles(spark, TESTDATA).persist()


def test_all_orders_are_positions(spark, everyone):
    orders = tables.table(spark, TESTDATA, "orders").select("o_orderkey").distinct()
    assert everyone.agg(F.sum(F.size("positions"))).first()[0] == orders.count()


def test_all_line_items_are_skills(spark, everyone):
    triples = tables.skill_rows(spark, TESTDATA).select("pos", "skill").distinct()
    assert everyone.agg(F.sum(F.size("skills"))).first()[0] == triples.count()


def test_years_of_any_length(spark):
    texts = ["2000-01", "12012-01-01", "+7", "0005", "99999999999", "-5-01", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").select(date_year(F.col("d")).alias("y"))
    assert [r["y"] for r in df.collect()] == [2000, 12012, 7, 5, None, None, None, None, None]


def test_far_years_unfold(spark, profiles):
    df = profiles({"positions": [("1999", "201999")]})
    years = op.position_years(df, ["pid"], 1996, 2001)
    assert years.agg(F.count("*"), F.min("year"), F.max("year")).first()[:] == (200001, 1999, 201999)
    panel = op.profile_year_panel(df, 1996, 2001, position_fields=())
    assert panel.agg(F.count("*"), F.max("relevant_experience")).first()[:] == (200001, 200000)
    assert op.null_sector_count(df.withColumn("sector", F.lit(None).cast("string"))).first()[:] == (200001, 1)


def test_order_holds_every_sector(spark):
    data = [(i, s, 2000 - i % 3) for i, s in enumerate(["OFF_THE_LIST", SECTORS[0], None, SECTORS[1]] * 6)]
    ordered = op.sector_year_order(spark.createDataFrame(data, "pid long, sector string, year int"))
    got = [tuple(r[c] for c in ("sector", "year", "pid")) for r in ordered.collect()]
    assert len(got) == 18 and got == sorted(got)
    assert {r["group_no"] for r in ordered.collect()} == {1, 2, 3}


@pytest.fixture
def low_limit(spark):
    """Spark broadcasts tables of a few rows only."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20000")
    yield
    spark.conf.set(limit, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_people_are_not_shuffled_by_sector(spark, low_limit):
    """The table of top tags is small, whatever the size of the counts it comes from."""
    people = spark.range(40000).select(
        F.col("id").alias("pid"),
        F.concat(F.lit("i"), F.col("id") % 9).alias("industry"),
        F.array(F.concat(F.lit("s"), F.col("id"))).alias("skills"),
    )
    lookup = spark.createDataFrame([(f"i{i}", SECTORS[i]) for i in range(9)], "industry string, sector string")
    _, top_tags = jobs.tag_tables(people, lookup, batch=())
    plan = plan_of(op.attach_top_tags(people.withColumn("sector", F.col("industry")), top_tags))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_test_rows_are_not_shuffled_by_sector(spark, low_limit, everyone):
    """Nor are they in the whole job: models come to the test rows."""
    assert "hashpartitioning(sector" not in plan_of(QUERIES["vote"](spark, TESTDATA))
    lookup = Inputs(spark, TESTDATA).sector_lookup
    tag_sector, top_tags = jobs.tag_tables(everyone, lookup)
    assigned = op.assign_sector(jobs.learning_profiles(everyone), lookup, tag_sector)
    evidence = jobs.evidence_table(assigned, top_tags, *YEARS, TEST_YEAR)
    assert "hashpartitioning" not in plan_of(jobs.predictions_from_evidence(evidence, TEST_YEAR))


def test_locations_are_resolved_once(spark):
    people = spark.range(5000).select(F.col("id").alias("pid"), F.concat(F.lit("Town "), F.col("id") % 3).alias("location"))
    places = spark.createDataFrame([("0", "A"), ("1", "B"), ("Town", "C")], "token string, country string")
    got = op.resolve_country(people, places)
    assert rows(got.groupBy("country").count()) == [("C", 5000)]
    assert "hashpartitioning(pid" not in got._jdf.queryExecution().executedPlan().toString()
