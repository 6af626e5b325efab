"""Whitening of embeddings with MLlib's BlockMatrix.

Entries become whole numbers, so means and deviations are exact. The distinct vectors are the fit list: its
centred rows lie in blocks of a distributed matrix, whose transpose times itself is the scatter; the
driver decomposes that small matrix, and a second multiplication projects the rows.

A block matrix deals its blocks out by a grid that cuts rows and columns alike, so a tall matrix would
come in few, large partitions. For the projection, the blocks are therefore laid out as a square, and the
whitening matrix stands once for each of its columns, on a diagonal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careerloom.llm.common import shared_folder, written

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries from here on are no usable numbers: differences of two would not fit a long.
TOO_LARGE = 2.0**62
COMPONENTS = 16
#: Bytes of a block, about; and blocks that one task of the scatter multiplies.
BLOCK_BYTES = 1 << 22
BLOCKS_PER_TASK = 8
#: Sums of longs are taken in two halves, so that they are exact.
HALF = 26

MATRIX = MatrixUDT.sqlType()
NUMBERED = [T.StructField("part", T.IntegerType()), T.StructField("no", T.IntegerType())]


def whole_numbers(vector: Column) -> Column:
    """The vector as array<bigint>; null if it is null or holds an entry that is null, not finite or too large."""
    scaled = F.transform(vector, lambda c: c.cast("double") * SCALE)
    usable = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < TOO_LARGE, F.lit(False)))
    return F.when(usable, F.transform(scaled, lambda c: F.floor(c) + SHIFT))


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and their sum in each dimension, exactly. The driver gets a row for each dimension."""
    entries = fit.select(F.posexplode("x").alias("pos", "c"))
    sums = (
        entries.groupBy("pos")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.shiftright("c", HALF)).alias("high"),
            F.sum(F.col("c").bitwiseAND(F.lit((1 << HALF) - 1))).alias("low"),
        )
        .orderBy("pos")
        .collect()
    )
    return sums[0]["n"], [(r["high"] << HALF) + r["low"] for r in sums]


class Centre:
    """The mean of the fit list as a whole number and a rest: S = n * base + rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)^2 of each row, null where it doesn't fit a long."""
        apart = x - self.base
        widest = self.n * (float(np.abs(apart).max(initial=0)) + 1)
        if widest * widest * x.shape[1] >= 2.0**62:
            apart, rest = apart.astype(object), self.rest.astype(object)
            exact = ((self.n * apart - rest) ** 2).sum(axis=1)
            return [int(v) if v < 1 << 63 else None for v in exact]
        return ((self.n * apart - self.rest) ** 2).sum(axis=1).tolist()


def blocks_of(rows: DataFrame, centre: Centre, height: int) -> DataFrame:
    """Rows (id, x) as blocks: part, no, ids, deviations, and the matrix of the centred rows.

    A block has `height` rows; those of the last one of a task that nothing fills are zero.
    """
    width = len(centre.base)
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [
            *NUMBERED,
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("deviations", T.ArrayType(T.LongType())),
            T.StructField("matrix", MATRIX),
        ]
    )

    def block(part: int, no: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        values = np.zeros((height, width))
        values[: len(x)] = centre.centred(x)
        ids = table.column("id").combine_chunks()
        none = pa.array([None], pa.list_(pa.int32()))
        # Row by row, which MLlib calls transposed.
        matrix = [
            pa.array([1], pa.int8()), pa.array([height], pa.int32()), pa.array([width], pa.int32()), none, none,
            pa.array([values.ravel()], pa.list_(pa.float64())), pa.array([True]),
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([no], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([centre.deviations(x)], pa.list_(pa.int64())),
                pa.StructArray.from_arrays(matrix, names=MATRIX.names),
            ],
            names=schema.names,
        )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no, held, count = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, height - count)
                held.append(taken)
                count += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if count == height:
                    yield block(part, no, held)
                    no, held, count = no + 1, [], 0
        if count:
            yield block(part, no, held)

    return rows.select("id", "x").mapInArrow(make, schema)


class Blocks:
    """A written table of blocks. Its matrix can be laid out as a column or as a square."""

    def __init__(self, df: DataFrame, name: str, height: int, width: int):
        self.height, self.width = height, width
        self.path = shared_folder(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.spark, self.schema = df.sparkSession, df.schema
        read = self.read(MatrixUDT())
        most = read.agg(F.max("part").alias("part"), F.max("no").alias("no"), F.count("*").alias("n")).first()
        self.per_part, self.count = most["no"] + 1, most["n"]
        self.places = (most["part"] + 1) * self.per_part
        self.side = math.isqrt(self.places - 1) + 1
        self.table = read.withColumn("number", F.col("part").cast("long") * self.per_part + F.col("no"))

    def read(self, kind: T.DataType) -> DataFrame:
        """The table. A matrix is stored as a struct, and is one or the other by the type with which it is read."""
        fields = [T.StructField(f.name, kind if f.name == "matrix" else f.dataType) for f in self.schema]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.path)

    def plain(self) -> DataFrame:
        return self.read(MATRIX)

    def laid_out(self, row: Column, column: Column, rows: int, columns: int) -> BlockMatrix:
        place = F.struct(row.alias("_1"), column.alias("_2"))
        df = self.table.select(place.alias("_1"), F.col("matrix").alias("_2"))
        return as_block_matrix(df, self.height, self.width, rows, columns)

    def column(self) -> BlockMatrix:
        return self.laid_out(F.col("number"), F.lit(0).cast("long"), self.places, 1)

    def square(self) -> BlockMatrix:
        n = F.lit(self.side).cast("long")
        return self.laid_out(F.floor(F.col("number") / n), F.col("number") % n, self.side, self.side)

    def scatter(self) -> np.ndarray:
        """The transpose times the matrix itself; the products of a few blocks each are added up."""
        tall = self.column()
        tasks = max(1, self.count // BLOCKS_PER_TASK)
        flat = tall.transpose()._java_matrix_wrapper.call("multiply", tall._java_matrix_wrapper._java_model, tasks)
        product = BlockMatrix(flat, self.width, self.width).toLocalMatrix().toArray()
        return (product + product.T) / 2

    def times(self, matrix: np.ndarray, name: str) -> Blocks:
        """The rows times a small matrix, as a written table of blocks with the numbers of these."""
        spark, columns = self.spark, matrix.shape[1]
        flat = matrix.ravel("F")
        diagonal = spark.sparkContext.parallelize(range(self.side), min(self.side, 64)).map(
            lambda j: ((j, j), DenseMatrix(len(flat) // columns, columns, flat))
        )
        small = BlockMatrix(diagonal, self.width, columns, self.side * self.width, self.side * columns)
        product = self.square().multiply(small)
        found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
        number = F.col("_1")["_1"].cast("long") * self.side + F.col("_1")["_2"]
        return Blocks(
            found.select(
                F.floor(number / self.per_part).cast("int").alias("part"),
                (number % self.per_part).cast("int").alias("no"),
                F.col("_2").alias("matrix"),
            ),
            name,
            self.height,
            columns,
        )


def as_block_matrix(df: DataFrame, height: int, width: int, rows: int, columns: int) -> BlockMatrix:
    """Blocks (struct(row, column), matrix) as a matrix of so many rows and columns of blocks."""
    shape = (height, width, rows * height, columns * width)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", df, *shape), *shape)


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whitening matrix, share of the variance, and whether a component has variance, by falling eigenvalue."""
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    varied = values > max(values.max(initial=0), 0) * len(scatter) * np.finfo(float).eps
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, values, 1)), 0)
    total = np.trace(scatter) / n
    return vectors * scale, np.where(varied, values / (total or 1), 0), varied


RESULT = [
    T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType()),
]


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = COMPONENTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold an entry that is null, not finite, or at least 2^56 in size,
    give no rows; nor do vectors of another length than the most frequent one (of equally frequent ones the
    longest). Equal vectors count once in the fit list, and all their rows are returned; ids may repeat or be null, and
    other columns aren't read. A component without variance has whitened null and explained 0, and
    identity_error (null without any variance) leaves it out. deviation is null where it doesn't fit a long. An
    empty table, or one without a usable vector, gives no rows.
    """
    spark = rows.sparkSession
    numbers = rows.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x"))
    schema = T.StructType([T.StructField("id", numbers.schema["id"].dataType), *RESULT])
    lengths = numbers.filter("size(x) > 0").groupBy(F.size("x").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    width = common["d"]
    numbers = numbers.filter(F.size("x") == width)
    fit = written(numbers.select("x").distinct(), "vectors")
    n, sums = moments(fit)
    centre, height = Centre(n, sums), max(1, block_bytes // (8 * width))

    fit_blocks = Blocks(blocks_of(fit.withColumn("id", F.lit(0)), centre, height), "fit-blocks", height, width)
    matrix, explained, varied = components(fit_blocks.scatter(), n, most)
    error = None
    if varied.any():
        covariance = fit_blocks.times(matrix, "fit-whitened").scatter() / n
        error = float(np.abs(covariance - np.eye(len(covariance)))[np.ix_(varied, varied)].max())

    all_blocks = Blocks(blocks_of(numbers, centre, height), "blocks", height, width)
    whitened = all_blocks.times(matrix, "whitened")
    count = matrix.shape[1]

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, deviations = batch.column("ids")[i].values, batch.column("deviations")[i].values
                values = batch.column("values")[i].values.to_numpy(zero_copy_only=False)
                by_row = batch.column("isTransposed")[i].as_py()
                values = values.reshape(height, count) if by_row else values.reshape(count, height).T
                each = pa.array(np.repeat(np.arange(len(ids)), count))
                flat = np.where(varied, values[: len(ids)], np.nan).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(each),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(ids))),
                        pa.array(np.full(len(each), n, np.int64)),
                        deviations.take(each),
                        pa.array(flat, pa.float64(), from_pandas=True),
                        pa.array(np.tile(explained, len(ids))),
                        pa.array([error] * len(each), pa.float64()),
                    ],
                    names=schema.names,
                )

    own = all_blocks.table.select("part", "no", "ids", "deviations")
    met = whitened.plain().select("part", "no", "matrix.values", "matrix.isTransposed").join(own, ["part", "no"])
    return met.mapInArrow(unfold, schema)
