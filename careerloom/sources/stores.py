"""Tables that later jobs read by key: classifiers by sector, profiles by year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from careerloom.functions import missing_sector
from careerloom.sources.outputs import observed, written_table

MODELS = (
    "model_year int, label string, n_rows bigint, mean_connections double, sd_connections double, "
    "mean_experience double, sd_experience double, tag_counts array<bigint>, sector string"
)
YEAR_ROWS = (
    "sector string, first_name string, last_name string, num_connections string, location string, "
    "rel_experience int, last_title string, last_company string, load string, year int"
)


def model_store(models: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the model table, one folder per sector.

    A sector has two rows per training year, so one task per sector is enough.
    """
    models.repartition("sector").write.mode(mode).partitionBy("sector").parquet(path)


def model_replace(models: DataFrame, path: str) -> None:
    """Write models over a store, but leave the sectors alone that have none among them. The models may have been read from it."""
    (
        written_table(models)
        .repartition("sector")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sector")
        .parquet(path)
    )


def model_load(spark: SparkSession, path: str, sectors: Iterable[str] | None = None) -> DataFrame:
    """Read the model table, or only the folders of the given sectors. A store without models has no rows."""
    models = spark.read.schema(MODELS).parquet(path)
    return models if sectors is None else models.filter(F.col("sector").isin(list(sectors)))


#: Bytes of a row group of the year store: small, so that a scan of one sector passes over most groups of a file.
KEY_GROUP_BYTES = 16 << 20
#: Rows of a page, the smallest part of a group that a scan of a range of keys passes over.
KEY_PAGE_ROWS = 5000


def year_store_write(rows: DataFrame, path: str, load: str = "all", id_col: str = "pid") -> Observation:
    """Add year-store rows under the name of a load, one folder per load and year; observe their number, ``n_rows``.

    The rebalance shuffle gives each year few, evenly sized files and splits a
    year that is much larger than the others. Other loads are left alone;
    writing the same load again replaces all of it. Within a file, rows lie in the order of
    (sector, id; rows need not have an id), in small row groups with a bloom filter on the sector.
    """
    dealt, observation = observed(rows.hint("rebalance", "year"), n_rows=F.count("*"))
    (
        dealt.sortWithinPartitions(*(c for c in ("year", "sector", id_col) if c in rows.columns))
        .write.mode("overwrite")
        .option("parquet.block.size", KEY_GROUP_BYTES)
        .option("parquet.page.row.count.limit", KEY_PAGE_ROWS)
        .option("parquet.bloom.filter.enabled#sector", "true")
        .option("parquet.bloom.filter.expected.ndv#sector", "1000")
        .partitionBy("year")
        .parquet(f"{path}/load={load}")
    )
    return observation


def year_store_read(spark: SparkSession, path: str, id_col: str = "pid", id_type: str = "bigint") -> DataFrame:
    """The rows of all loads, with the name of their ``load``."""
    return spark.read.schema(f"`{id_col}` {id_type}, {YEAR_ROWS}").parquet(path)


def year_store_keys(
    store: DataFrame,
    year: int,
    sector: str | None = None,
    first_id: object = None,
    before_id: object = None,
    id_col: str = "pid",
) -> DataFrame:
    """The store's rows of a year, of a sector in it, and of ids from ``first_id`` to below ``before_id`` in that.

    This is a range of the key (year, sector, id): the year prunes to a single folder of each load; sector
    and ids are compared with the statistics and bloom filters of row groups and pages, which are
    passed over where nothing fits. Ids are bounded only within a sector, as a range of keys is. A row without a sector has the sector ''.
    """
    if sector is None and (first_id is not None or before_id is not None):
        raise ValueError("a range of ids needs a sector")
    rows = store.filter(F.col("year") == year)
    if sector is not None:
        rows = rows.filter(F.col("sector") == sector)
    if first_id is not None:
        rows = rows.filter(F.col(id_col) >= first_id)
    if before_id is not None:
        rows = rows.filter(F.col(id_col) < before_id)
    return rows


def year_store_scan(store: DataFrame, year: int, sector: str | None = None) -> DataFrame:
    """Profiles of one year, or of one sector in it: the row's cells, with one position that starts in that year.

    Rows without a sector or location are left out. On a stored table the year
    condition prunes to a single folder, and the sector to the row groups and pages that hold it.
    """
    return (
        year_store_keys(store, year, sector)
        .filter(~missing_sector(F.col("sector")) & (F.col("location") != ""))
        .select(
            "pid",
            "first_name",
            "last_name",
            "num_connections",
            F.col("sector").alias("industry"),
            "location",
            F.array().cast("array<string>").alias("skills"),
            F.array(
                F.struct(
                    F.lit("").alias("summary"),
                    F.col("last_title").alias("title"),
                    F.col("year").cast("string").alias("start_date"),
                    F.lit("").alias("end_date"),
                    F.lit(False).alias("is_current"),
                    F.col("last_company").alias("company_name"),
                )
            ).alias("positions"),
        )
    )
