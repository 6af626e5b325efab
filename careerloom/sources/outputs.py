"""Sinks for key lists, named outputs and JSON profiles, and intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from careerloom.schema import POSITION_JSON_NAMES, PROFILE_JSON_NAMES


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach: in ``spark.checkpoint.dir``, or without it in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/careerloom-{uuid.uuid4().hex}"


def written_table(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Cuts the lineage, survives lost executors, is computed once however often
    it is used, and gives Spark the true size for choosing joins.
    """
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_list_lines(
    df: DataFrame, key: str, values: str, keep: Sequence[str] = ()
) -> DataFrame:
    """(kept columns, value): a text line ``key,v1,v2,...`` per row, values in their order."""
    return df.select(*keep, F.concat_ws(",", F.col(key), F.col(values)).alias("value"))


def write_key_list(
    df: DataFrame, path: str, key: str, values: str, mode: str = "overwrite"
) -> None:
    """Write the lines of :func:`key_list_lines` as text."""
    key_list_lines(df, key, values).write.mode(mode).text(path)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows, and an observation of aggregates over them that is filled by the job that writes them.

    Observe what a writing stage itself computes, after its last shuffle: of a task that runs again, only
    the attempt that succeeds is counted there.
    """
    observation = Observation()
    return df.observe(observation, *(c.alias(name) for name, c in metrics.items())), observation


def observed_row(spark: SparkSession, observation: Observation, schema: str) -> DataFrame:
    """What was observed as a table of one row, with the columns of ``schema``."""
    found = observation.get
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(found[n] for n in names)], schema)


def write_named_outputs(
    outputs: Mapping[str, DataFrame], path: str, format: str = "text", mode: str = "overwrite"
) -> None:
    """Write each frame under its own name: ``path/name``, all of them in one job.

    The rows of all frames are written together, partitioned by the name of their output, into a hidden folder
    of ``path``; then each output takes its place. The rebalance gives an output few and even files, whatever
    the size of the others. Frames with different columns can't be written together and are written one by one.
    Give frames with a common costly parent through :func:`written_table`, so
    that the parent is computed once.
    """
    frames = list(outputs.values())
    if len({tuple(df.dtypes) for df in frames}) != 1:
        for name, df in outputs.items():
            df.write.mode(mode).format(format).save(f"{path}/{name}")
        return
    spark = frames[0].sparkSession
    places = {name: _Place(spark, f"{path}/{name}") for name in outputs}
    if mode in ("error", "errorifexists"):
        for place in places.values():
            if place.exists():
                raise FileExistsError(f"{place.path} exists")
    if mode == "ignore":
        outputs = {name: df for name, df in outputs.items() if not places[name].exists()}
    if not outputs:
        return
    named = [df.withColumn("__output", F.lit(name)) for name, df in outputs.items()]
    together = reduce(DataFrame.unionByName, named).hint("rebalance", "__output")
    hidden = f"{path}/.{uuid.uuid4().hex}"
    together.write.format(format).partitionBy("__output").save(hidden)
    for name in outputs:
        places[name].take(f"{hidden}/__output={name}", replace=mode == "overwrite")
    _Place(spark, hidden).remove()


class _Place:
    """A folder, on whatever file system Spark finds it."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self.path = self._hadoop.Path(path)
        self.files = self.path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def remove(self) -> None:
        self.files.delete(self.path, True)

    def take(self, source: str, replace: bool) -> None:
        """Move the files of a written folder here; an output without rows becomes an empty folder."""
        if replace:
            self.remove()
        self.files.mkdirs(self.path)
        source = self._hadoop.Path(source)
        for status in self.files.listStatus(source) if self.files.exists(source) else []:
            file = status.getPath()
            if not self.files.rename(file, self._hadoop.Path(self.path, file.getName())):
                raise OSError(f"{file} can't be moved to {self.path}")
        self.files.create(self._hadoop.Path(self.path, "_SUCCESS"), True).close()


def _json_position(p: Column) -> Column:
    return F.struct(*[p[column].alias(name) for column, name in POSITION_JSON_NAMES.items()])


def profile_json_lines(profiles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, value): a JSON object per profile under the JSON names, without null fields."""
    fields = [
        (F.transform(column, _json_position) if column == "positions" else F.col(column)).alias(name)
        for column, name in PROFILE_JSON_NAMES.items()
        if column in profiles.columns
    ]
    return profiles.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def write_profile_json(profiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the lines of :func:`profile_json_lines` as text."""
    profile_json_lines(profiles).write.mode(mode).text(path)


def read_matching_files(
    spark: SparkSession,
    folder: str,
    pattern: str,
    format: str = "text",
    first_only: bool = False,
) -> DataFrame:
    """The files and named outputs of ``folder`` whose name contains ``pattern``, as one frame.

    A named output is a folder of files that were written together, as by
    :func:`write_named_outputs`. ``first_only`` keeps the first match by name.
    """
    found = matching_paths(spark, folder, pattern)
    if not found:
        raise FileNotFoundError(f"nothing in {folder} has {pattern!r} in its name")
    return spark.read.format(format).load(found[:1] if first_only else found)


def _literal(name: str) -> str:
    """A name in which no character is a wildcard."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in name)


def matching_paths(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the files and named outputs directly in ``folder`` whose name contains ``pattern``, sorted, for ``load``."""
    glob = f"*{_literal(pattern)}*"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{glob}")
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path) or []
    paths = [status.getPath() for status in found]
    return sorted(_literal(p.toString()) for p in paths if not p.getName().startswith(("_", ".")))
