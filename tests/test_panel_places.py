"""Panels by year, the year store's rows, countries and headcounts, words."""

from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from careerloom import operators as op

PLACE = "token string, country string"


def test_panel_has_gap_years_and_active_positions(spark, profiles):
    df = profiles({"pid": 1, "positions": [("2000", "2001"), ("2003", "2003"), ("2001/5/1", "2001-01")]}, {"pid": 2})
    panel = op.profile_year_panel(df)
    got = rows(panel.select("pid", "year", "relevant_experience", F.size("positions")))
    assert got == [(1, 2000, 0, 1), (1, 2001, 1, 2), (1, 2002, 2, 0), (1, 2003, 3, 1)]
    assert rows(op.position_years(df).select("year")) == [(2000,), (2001,), (2001,), (2003,)]


def test_end_before_start_moves_the_span_only(spark, profiles):
    df = profiles(
        {"pid": 1, "positions": [("2000", "1998")]},
        {"pid": 2, "positions": [("2000", "1998"), ("1999", "1999")]},
        {"pid": 3, "positions": [("1970", "1975")]},
        {"pid": 4, "positions": [("x", "2000"), ("2000", "y")]},
    )
    assert rows(op.profile_year_panel(df).select("pid", "year")) == [(2, 1999)]
    assert op.position_years(df).count() == 1
    assert rows(op.year_store_rows(df).select("pid", "year")) == [(2, 1999), (4, 0)]


def test_open_end_lasts_until_the_last_year_and_later_ends_are_kept(spark, profiles):
    df = profiles({"pid": 1, "positions": [("2010", None)]}, {"pid": 2, "positions": [("2012", "2014")]})
    years = op.profile_year_panel(df).select("pid", "year")
    assert rows(years) == [(1, 2010), (1, 2011), (1, 2012), (2, 2012), (2, 2013), (2, 2014)]


def test_last_listed_position_wins(spark, profiles):
    def p(title, start, end, company=None):
        return {"title": title, "start_date": start, "end_date": end, "company_name": company}

    df = profiles({"pid": 1, "positions": [p("b", "2001", "2003", "x"), p("a", "2000", "2001"), p(None, "2003", "2003", "z")]})
    assert rows(op.last_known_position(df)) == [
        (1, 2000, "a", ""), (1, 2001, "a", ""), (1, 2002, "b", "x"), (1, 2003, "", "z"),
    ]


def test_year_store_rows(spark, profiles):
    df = profiles({"pid": 1, "positions": [("2000", "2000")], "first_name": None, "num_connections": None})
    row = op.year_store_rows(df).first().asDict()
    assert row == {
        "year": 2000, "pid": 1, "sector": "", "first_name": "", "last_name": "", "num_connections": "",
        "location": "", "rel_experience": 0, "last_title": "t", "last_company": "c",
    }
    given = df.withColumn("relevant_experience", F.lit(4))
    assert op.year_store_rows(given).first()["rel_experience"] == 4


def test_position_year_counts(spark, profiles):
    df = profiles(
        {"positions": [{"start_date": "2011", "is_current": True}, {"start_date": "2010", "end_date": "2011"},
                       {"start_date": "2010", "end_date": None}]}
    )
    counted = op.position_year_counts(df)
    assert rows(counted) == [(2010, 1), (2011, 2), (2012, 1)]
    assert rows(op.position_year_counts(df.union(df))) == [(2010, 2), (2011, 4), (2012, 2)]


def test_null_sector_count(spark, profiles):
    df = profiles(
        {"positions": [("2000", "2004")]}, {"positions": [("2000", "2001")]}, {"positions": []},
    ).withColumn("sector", F.when(F.col("pid") == 1, F.lit("LEGAL")))
    assert rows(op.null_sector_count(df)) == [(5, 1)]
    assert rows(op.null_sector_count(df.filter("pid = 1"))) == [(0, 0)]


def test_sector_year_order_spreads_a_dominant_sector(spark):
    panel = spark.range(20000).selectExpr(
        "id AS pid", "IF(id % 3 = 0, 'LEGAL', IF(id % 3 = 1, 'ENERGY', 'UNKNOWN')) AS sector",
        "CAST(1990 + id % 2 AS INT) AS year",
    )
    ordered = op.sector_year_order(panel)
    parts = ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    got = parts.orderBy("at").select("sector", "year", "pid", "group_no", "part").collect()
    keys = [tuple(r)[:3] for r in got]
    assert keys == sorted(keys) and len(keys) == 20000
    assert {(r["year"], r["group_no"]) for r in got} == {(1990, 1), (1991, 2)}


def places(spark):
    return spark.createDataFrame([("Georgia", "USA"), ("Paris", "France"), ("France", "France")], PLACE)


def test_resolve_country_takes_the_first_known_word(spark, profiles):
    locations = [None, "", "Greater  Paris Area", "Georgia Paris", "New York", "Paris,", "  Paris"]
    df = profiles(*[{"location": x} for x in locations])
    assert rows(op.resolve_country(df, places(spark))) == [(2, "France"), (3, "USA"), (6, "France")]
    assert rows(op.location_tokens(df.filter("pid = 2"))) == [
        (2, 0, "Greater"), (2, 1, ""), (2, 2, "Paris"), (2, 3, "Area"),
    ]


def test_headcount_active_never_exceeds_span(spark, profiles):
    df = profiles(
        {"industry": "LEGAL", "location": "Paris", "positions": [("2000", "2002")]},
        {"industry": "LEGAL", "location": "Paris", "positions": [("2000", "2000"), ("2002", "2002")]},
        {"industry": "LEGAL", "location": "Rome", "positions": [("2001", "2001")]},
        {"industry": "null", "location": "Paris", "positions": [("2001", "2001")]},
        {"industry": None, "location": "Paris", "positions": [("2001", "2001")]},
    )
    active = op.sector_country_active(df, places(spark), 2001)
    assert rows(active) == [("LEGAL", "France", 1)]
    span = op.sector_country_span(op.year_store_rows(df), places(spark), 2001)
    assert rows(span) == [("LEGAL", "France", 2)]
    doubled = op.sector_country_active(df.union(df), places(spark), 2001)
    assert rows(doubled) == [("LEGAL", "France", 2)]


def test_words_and_lines(spark):
    texts = spark.createDataFrame([("a b  a\tc\r\n\ta \n",), ("",), ("a\rb",), (None,), ("\n\n",)], "value string")
    assert [tuple(r) for r in op.token_frequency(texts).collect()] == [("a", 3), ("b", 2), ("a\tc", 1)]
    assert rows(op.line_count(op.text_lines(texts))) == [(6,)]


def test_lookups_are_broadcast_and_big_sides_are_not_shuffled(spark, profiles, tmp_path):
    profiles({"pid": 1, "industry": "i", "location": "Paris"}).write.parquet(str(tmp_path / "p"))
    places(spark).write.parquet(str(tmp_path / "l"))
    people = spark.read.parquet(str(tmp_path / "p"))
    lookup = spark.read.parquet(str(tmp_path / "l")).withColumnsRenamed({"token": "industry", "country": "sector"})
    plan = op.industry_sector_join(people, lookup)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_panel_reads_only_dates_and_never_shuffles(spark, profiles, tmp_path):
    profiles({"pid": 1, "positions": [("2000", "2001")]}).write.parquet(str(tmp_path / "p"))
    people = spark.read.parquet(str(tmp_path / "p")).select("pid", "positions")
    panel = op.profile_year_panel(people, position_fields=())
    plan = panel._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    schema = [s for s in _scans(plan)][0]
    assert "start_date" in schema and "summary" not in schema and "title" not in schema


def _scans(plan):
    leaves = plan.collectLeaves()
    return [leaves.apply(i).requiredSchema().json() for i in range(leaves.size())]
