"""Text and date expressions on edge values."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from careerloom import functions as cf


def apply(spark, fn, *values):
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_tag_keeps_inner_spaces(spark):
    assert apply(spark, cf.clean_tag, "Oil & Energy", " C++ ", None, "&&", "a_b\t", "é1") == [
        "Oil  Energy", "C", "", "", "a_b", "1",
    ]


def test_blank_covers_control_characters(spark):
    assert apply(spark, cf.is_blank, None, "", " \t\n", "x", "\u00a0") == [True, True, True, False, False]


def test_connections(spark):
    values = (None, "500+", "+1+", "many", "", "12")
    assert apply(spark, cf.clean_connections, *values) == ["0", "500", "1", "many", "", "12"]
    assert apply(spark, cf.connection_count, *values) == [0, 500, 1, 0, 0, 12]


@pytest.mark.parametrize(
    ("text", "year"),
    [
        ("2008-02-01", 2008), ("2008", 2008), ("abc", None), ("", None), ("2008 ", None), ("-5-01", None),
        ("+2008-1", 2008), ("2008/02/01", None), (None, None), ("02008", 2008), ("20080201", 20080201),
        ("99999999999", None), ("20 08", None), ("2008\n", None), ("0", 0), ("2008-", 2008),
    ],
)
def test_date_year(spark, text, year):
    assert apply(spark, cf.date_year, text) == [year]


def test_split_fields_drops_trailing_empty_ones(spark):
    assert apply(spark, cf.split_fields, "a,b,,", "a", "", "a,,b") == [["a", "b"], ["a"], [""], ["a", "", "b"]]


def intervals(spark, profiles, positions, interval):
    df = profiles({"positions": positions}).select(F.posexplode("positions").alias("i", "p"))
    span = interval(F.col("p"), 1980, 2012)
    return [tuple(r) for r in df.orderBy("i").select(span["from_year"], span["to_year"]).collect()]


def test_position_interval(spark, profiles):
    positions = [
        ("1970-01-01", "1990-01-01"), ("2000/05/01", None), (None, "2000-01-01"), ("x", "2000"),
        ("2000", "soon"), ("2010", "2030"), ("1960", "1970"), ("2005", "2001"), ("2005", ""),
    ]
    assert intervals(spark, profiles, positions, cf.position_interval) == [
        (1980, 1990), (2000, 2012), (None, 2000), (None, 2000), (2000, None), (2010, 2030),
        (1980, 1970), (2005, 2001), (2005, None),
    ]


def test_position_interval_current(spark, profiles):
    positions = [
        {"start_date": "2000-01", "end_date": "2003-01", "is_current": True},
        {"start_date": "2000-01", "end_date": "2003-01", "is_current": False},
        {"start_date": "2000-01", "end_date": None, "is_current": None},
        {"start_date": "2000/01", "end_date": "2003", "is_current": False},
    ]
    assert intervals(spark, profiles, positions, cf.position_interval_current) == [
        (2000, 2012), (2000, 2003), (2000, None), (None, 2003),
    ]


def test_normalize_positions(spark, profiles):
    df = profiles({"positions": [("2000/1/1", "2001/1/1"), (None, "2001/1/1")]})
    clean = df.select(F.explode(cf.normalize_positions(F.col("positions"))).alias("p")).select("p.*")
    assert rows(clean.select("summary", "start_date", "end_date")) == [
        ("s", None, "2001/1/1"), (None, "2000-1-1", "2001-1-1"),
    ]
