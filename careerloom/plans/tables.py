"""Profiles, lookups and text lines derived from the star-schema tables.

A customer is a person. Ten consecutive order keys belong to one person: they
give the positions and, with their line items, the skills. So a person's lists
are bounded by the keys, and repeated copies of a row count once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom.schema import POSITION_COLUMNS
from careerloom.sources import profile_json_lines

# Years of the derived data, and the market segments.
START_YEAR, END_YEAR, TEST_YEAR = 1996, 2001, 2000
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Person columns without lists."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("r_regionkey = n_regionkey")
    )
    customers = table(spark, folder, "customer")
    return customers.join(nations, F.expr("n_nationkey = c_nationkey")).selectExpr(
        "c_custkey AS pid",
        "c_nationkey AS batch",
        "c_name AS first_name",
        "CASE WHEN c_custkey % 3 = 0 THEN concat('L', c_nationkey) END AS last_name",
        """CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 'Unlisted'
                WHEN c_custkey % 23 = 0 THEN ' & '
                ELSE concat(c_mktsegment, ' & ', r_name) END AS industry""",
        """CASE WHEN c_custkey % 19 = 0 THEN NULL
                WHEN c_custkey % 5 = 1 THEN concat('Old  State_', c_nationkey % 8, ' ', r_name)
                WHEN c_custkey % 5 = 2 THEN r_name
                ELSE concat('Greater ', n_name, ' Area') END AS location""",
        """CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'many'
                WHEN c_acctbal > 5000 THEN '500+'
                ELSE CAST(CAST(floor(abs(c_acctbal) / 10) AS INT) AS STRING) END AS num_connections""",
    )


def position_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(pid, pos, position columns)."""
    half = "(o_custkey div 2)"
    month = "lpad(CAST(month(o_orderdate) AS STRING), 2, '0')"
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey div 10 AS pid",
        "o_orderkey AS pos",
        "concat('note ', o_orderkey) AS summary",
        "o_orderpriority AS title",
        f"""CASE WHEN {half} % 17 = 0 THEN NULL WHEN {half} % 31 = 1 THEN 'n/a'
                 WHEN {half} % 1009 = 7 THEN '12012-01-01'
                 WHEN {half} % 5 = 0 THEN concat(year(o_orderdate), '/', {month}, '/01')
                 ELSE concat(year(o_orderdate), '-', {month}, '-01') END AS start_date""",
        f"""CASE WHEN o_orderstatus = 'O' AND {half} % 3 > 0 THEN NULL
                 WHEN {half} % 37 = 2 THEN 'present'
                 WHEN {half} % 1009 = 12 THEN '2050-01-01'
                 WHEN {half} % 1009 = 13 THEN '99999999999-01-01'
                 ELSE concat(year(o_orderdate) + CAST({half} % 4 AS INT) - 1, '-06-01') END AS end_date""",
        "o_orderstatus = 'O' AS is_current",
        f"CASE WHEN {half} % 19 = 3 THEN NULL ELSE concat('Company ', o_custkey % 50) END AS company_name",
    )


def skill_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(pid, pos, skill): pos is the order and the line, of which an order may have several with the same number."""
    return table(spark, folder, "lineitem").selectExpr(
        "l_orderkey div 10 AS pid",
        "struct(l_orderkey, l_linenumber) AS pos",
        """CASE WHEN (l_orderkey div 10) % 35 = 0 THEN concat('Rare ', l_orderkey div 10)
                WHEN l_suppkey % 12 = 11 AND l_returnflag = 'R' THEN ' # '
                WHEN l_returnflag = 'A' THEN concat('C++ ', l_suppkey % 12)
                WHEN l_returnflag = 'N' THEN concat('R&D ', l_suppkey % 12)
                ELSE concat('Sales ', l_suppkey % 12) END AS skill""",
    )


def _lists(rows: DataFrame, column: str, fields: list[str], order: Sequence[str] = ("pos",)) -> DataFrame:
    entries = F.sort_array(F.collect_set(F.struct(*order, *fields)))
    return rows.groupBy("pid").agg(entries.alias(column))


def profiles(
    spark: SparkSession, folder: str, position_fields: Sequence[str] = POSITION_COLUMNS
) -> DataFrame:
    """Nested profiles, one row per person.

    Lists are gathered with only the ``position_fields`` asked for, so a job
    that needs dates does not shuffle the text.
    """
    positions = _lists(position_rows(spark, folder), "_positions", list(position_fields))
    # Flat entries are smaller and quicker to compare than entries with a struct for the place.
    skills = _lists(skill_rows(spark, folder), "_skills", ["skill"], ["pos.l_orderkey", "pos.l_linenumber"])
    listed = people(spark, folder).join(skills, "pid", "left").join(positions, "pid", "left")
    return listed.select(
        *[c for c in listed.columns if not c.startswith("_")],
        F.coalesce(F.col("_skills")["skill"], F.array()).alias("skills"),
        F.coalesce(
            F.transform("_positions", lambda p: F.struct(*[p[f].alias(f) for f in position_fields])),
            F.array(),
        ).alias("positions"),
    )


def sector_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(line_no, line) of an ``industry,sector`` file; some lines are overridden later."""
    segment = F.explode(F.array(*[F.lit(s) for s in SEGMENTS])).alias("segment")
    sector = F.expr(
        """CASE WHEN segment = 'AUTOMOBILE' THEN 'AUTOMOTIVE'
                WHEN segment = 'BUILDING' AND r_name IN ('ASIA', 'AFRICA', 'AMERICA') THEN 'CONSTRUCTION'
                WHEN segment = 'BUILDING' THEN 'REAL_ESTATE'
                WHEN segment = 'FURNITURE' THEN 'CONSUMER_PRODUCTS'
                WHEN segment = 'HOUSEHOLD' THEN 'RETAIL_WHOLESALE'
                WHEN r_name IN ('EUROPE', 'ASIA') THEN 'TECHNOLOGY'
                WHEN r_name = 'AMERICA' THEN 'OFF_THE_LIST' ELSE 'MANUFACTURING' END"""
    )
    named = table(spark, folder, "region").select("r_regionkey", "r_name", segment)
    numbered = named.select(
        F.concat_ws(" & ", "segment", "r_name").alias("industry"),
        sector.alias("sector"),
        (F.col("r_regionkey") * 10 + F.length("segment")).alias("line_no"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("again"),
    )
    return numbered.select(
        (F.col("line_no") + F.col("again") * 100).alias("line_no"),
        F.concat_ws(
            ",", "industry", F.when(F.col("again") == 0, F.lit("OUTDATED")).otherwise(F.col("sector"))
        ).alias("line"),
    )


def place_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(line_no, line) of a ``country,state,city`` file."""
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return nations.join(regions, F.expr("r_regionkey = n_regionkey")).selectExpr(
        "n_nationkey AS line_no", "concat_ws(',', r_name, concat('State_', n_nationkey % 8), n_name) AS line"
    )


def object_lines(people_with_lists: DataFrame) -> DataFrame:
    """(pid, value): one JSON object per person; some lines are broken, blank or null."""
    whole = profile_json_lines(people_with_lists, keep=("pid",))
    return whole.select(
        "pid",
        F.expr(
            """CASE WHEN pid % 31 = 1 THEN left(value, 30) WHEN pid % 31 = 2 THEN 'null'
                    WHEN pid % 31 = 3 THEN ' ' WHEN pid % 31 = 4 THEN concat('[', value, ']')
                    ELSE value END"""
        ).alias("value"),
    )


def array_lines(people_with_lists: DataFrame) -> DataFrame:
    """(line_no, value): JSON arrays of up to three people; some lines are broken, blank or null."""
    whole = profile_json_lines(people_with_lists, keep=("pid",))
    entries = F.sort_array(F.collect_set(F.struct("pid", "value")))["value"]
    lines = whole.groupBy(F.expr("pid div 3").alias("line_no")).agg(entries.alias("_objects"))
    return lines.select(
        "line_no",
        F.expr(
            """CASE WHEN line_no % 11 = 1 THEN left(concat('[', _objects[0]), 40)
                    WHEN line_no % 11 = 2 THEN 'null' WHEN line_no % 11 = 3 THEN ' '
                    WHEN line_no % 11 = 4 THEN _objects[0]
                    ELSE concat('[', array_join(_objects, ','), ']') END"""
        ).alias("value"),
    )


def strict_lines(lines: DataFrame) -> DataFrame:
    """(line_no, value): the lines of :func:`array_lines`; some of the good ones go on after the list or hold a value of a wrong type."""
    return lines.withColumn(
        "value",
        F.expr(
            """CASE WHEN line_no % 11 IN (1, 2, 3, 4) THEN value
                    WHEN line_no % 13 = 5 THEN concat(value, ' x')
                    WHEN line_no % 13 = 6 THEN replace(value, '"skills":[', '"relevantExperience":"many","skills":[')
                    ELSE value END"""
        ),
    )


def customer_pair_lines(customers: DataFrame) -> DataFrame:
    """(line_no, line): a ``key,value`` line per customer, many with the same key."""
    return customers.selectExpr(
        "c_custkey AS line_no",
        """CASE WHEN c_custkey % 17 = 0 THEN concat(c_mktsegment, ' ', c_nationkey, ',')
                ELSE concat_ws(',', concat(c_mktsegment, ' ', c_nationkey), concat('v', c_custkey % 10), 'x')
           END AS line""",
    )


def customer_place_lines(customers: DataFrame) -> DataFrame:
    """(line_no, line): a ``country,state,city`` line per customer; some are short or have gaps."""
    return customers.selectExpr(
        "c_custkey AS line_no",
        """CASE WHEN c_custkey % 17 = 0 THEN concat('Land_', c_nationkey, ',State_1')
                WHEN c_custkey % 17 = 1 THEN concat('Land_', c_nationkey, ',,City_', c_custkey % 97)
                ELSE concat_ws(',', concat('Land_', c_nationkey), concat('State_', c_custkey % 41),
                               concat('City_', c_custkey % 97))
           END AS line""",
    )
