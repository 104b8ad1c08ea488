"""Whitening of embeddings with distributed block matrices (Spark MLlib).

Rows get an index, are centred and go into a ``BlockMatrix``; its transpose times itself is the scatter.
``eigh`` of that small matrix runs on the driver, and a product with the whitening matrix projects all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

#: Bytes of a block of rows: the least, and the most, which is reached once there are BLOCKS of the least.
LEAST_BYTES, MOST_BYTES, BLOCKS = 1 << 20, 32 << 20, 20_000
#: Columns of a block.
WIDTH = 1024
#: Blocks of rows that one task multiplies. Their products are added before they leave it.
TOGETHER = 8
#: Eigenvalues below this share of the largest are rounding, not variance.
NO_VARIANCE = 1e-12

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def row_index() -> tuple[Column, Column]:
    """Part file and place in it, of stored rows."""
    return F.col("_metadata.file_name"), F.col("_metadata.row_index")


def numbered(frame: DataFrame) -> DataFrame:
    """Stored rows with ``index``, dense from 0. Only the counts of the part files are put in order."""
    file, place = row_index()
    held = frame.select("*", file.alias("part_file"), place.alias("part_row"))
    counts = held.groupBy(F.col("part_file").alias("file")).count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("file", before.alias("start"))
    # One row a part file: as many as tasks wrote them.
    joined = held.join(F.broadcast(starts), F.col("part_file") == F.col("file"))
    return joined.withColumn("index", F.col("start") + F.col("part_row")).drop("part_file", "part_row", "file", "start")


def block_matrix(rows: DataFrame, block_rows: int, dims: int) -> BlockMatrix:
    """From ``index, centred``: row ``index`` of the matrix is ``centred``, rows that are not there are 0.

    Rows are shuffled once, as they are, and packed where they arrive; ``IndexedRowMatrix.toBlockMatrix`` would send a
    pair of objects for every single entry.
    """

    def pack(key, group):
        values = np.zeros((block_rows, dims), order="F")
        entries = group.column("centred").combine_chunks().flatten().to_numpy().reshape(-1, dims)
        values[group.column("index").to_numpy() - key[0].as_py() * block_rows] = entries
        return pa.table([pa.array([key[0].as_py()]), pa.array([values.tobytes(order="F")], pa.binary())], ["block", "entries"])

    def cut(row):
        values = np.frombuffer(row.entries).reshape((block_rows, dims), order="F")
        for j, at in enumerate(range(0, dims, WIDTH)):
            part = values[:, at : at + WIDTH]
            yield (row.block, j), DenseMatrix(*part.shape, part.flatten(order="F"))

    numbered_rows = rows.withColumn("block", F.call_function("div", F.col("index"), F.lit(block_rows)))
    blocks = numbered_rows.groupBy("block").applyInArrow(pack, "block long, entries binary")
    return BlockMatrix(blocks.rdd.flatMap(cut), block_rows, min(WIDTH, dims))


def whole_rows(matrix: BlockMatrix) -> DataFrame:
    """``at, w`` of all rows of a matrix that is one block wide."""
    height = matrix.rowsPerBlock

    def spread(block):
        (i, _), part = block
        for k, row in enumerate(part.toArray().tolist()):
            yield i * height + k, row

    return matrix.blocks.flatMap(spread).toDF("at long, w array<double>")


def cross_product(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix itself. The rows are summed over in parts of ``TOGETHER`` blocks: undivided,
    all of them would meet in the one task of each block of the result."""
    java = matrix._java_matrix_wrapper._java_model
    parts = -(-java.numRowBlocks() // TOGETHER)
    # The option to divide them has no Python form.
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", java, parts)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def local_blocks(spark, values: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A small matrix, in blocks that fit below those of the rows."""
    blocks = [
        ((i, 0), DenseMatrix(*part.shape, part.flatten(order="F").tolist()))
        for i, part in enumerate(values[at : at + rows_per_block] for at in range(0, len(values), rows_per_block))
    ]
    parallel = spark.sparkContext.parallelize(blocks, len(blocks))
    return BlockMatrix(parallel, rows_per_block, values.shape[1], *values.shape)


def components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by size and unit eigenvectors as columns, at most ``count``, without those that have no
    variance. The largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    keep = values > NO_VARIANCE * max(values[:1].max(initial=0), 0)
    values, vectors = values[keep], vectors[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * signs


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    offset: int = 1_000_000,
    count: int = 16,
) -> DataFrame:
    """Principal components of the vectors, each scaled to unit variance.

    A component c becomes the long ``x = floor(scale * c) + offset``. Mean and covariance are over the distinct x
    vectors, with divisor n; all rows are projected. Returns a row for each row and component ``vec_id, component, n,
    deviation, whitened, explained, identity_error``: ``deviation`` is the sum over the dimensions of ``(n * x - S)^2``,
    ``explained`` the share of the component in the trace, ``identity_error`` the largest entry of
    the covariance of the distinct rows' whitened values minus the identity.

    Rows whose vector is null or has null or non-finite components are left out, and so are those of another
    length than most rows have (of equally many the longest). A null id stays. Repeated rows are projected each, and
    count once in the fit. Components without variance are left out, as nothing scales them to 1: rows all alike, and an
    empty table, give no rows. Other columns of any name are left out. ``deviation`` is null beyond a long.
    Vectors are d long with d * d doubles on the driver; d * d beyond 2^28 is an error.
    """
    spark = vectors.sparkSession
    entries = F.col(f"`{vector}`")
    broken = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(entries, lambda c: F.floor(c.cast("double") * scale) + offset)
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.when(~broken, whole).alias("x"))
    rows = stored(rows.where("size(x) > 0"), "whitening-rows")
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if most is None:
        return spark.createDataFrame([], RESULT)
    dims = most["d"]
    if dims * dims > 1 << 28:
        raise ValueError(f"vectors of {dims} components: their covariance is too large for the driver")
    rows = numbered(rows).where(F.size("x") == dims)

    # The first row of each distinct vector stands for it; partial aggregation takes copies out before the shuffle.
    fit = stored(rows.groupBy("x").agg(F.min("index").alias("index")), "whitening-fit")
    sums = fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s"), F.count("*").alias("n"))
    sums = sums.orderBy("pos").collect()
    n, total = sums[0]["n"], F.array(*[F.lit(r["s"]).cast("long") for r in sums])
    away = F.transform(F.arrays_zip(F.col("x").alias("x"), total.alias("s")), lambda p: p["x"] * F.lit(n).cast("long") - p["s"])
    centred = F.transform("away", lambda v: v.cast("double") / float(n))

    held = most["count"]
    least, largest = (max(size // (8 * dims), 1) for size in (LEAST_BYTES, MOST_BYTES))
    block_rows = min(max(least, held // BLOCKS), largest)
    fitted = block_matrix(fit.withColumn("away", away).select("index", centred.alias("centred")), block_rows, dims)
    fitted.persist(StorageLevel.MEMORY_AND_DISK)  # four products read it; lost blocks are packed again
    covariance = cross_product(fitted) / n
    values, directions = components(covariance, count)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    projection = local_blocks(spark, directions / np.sqrt(values), min(WIDTH, dims))
    again = cross_product(fitted.multiply(projection)) / n
    fitted._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = float(np.abs(again - np.eye(len(values))).max())

    rows = rows.withColumn("away", away)
    projected = block_matrix(rows.select("index", centred.alias("centred")), block_rows, dims).multiply(projection)
    whitened = stored(whole_rows(projected), "whitened")
    squares = F.transform("away", lambda v: v.cast("decimal(19,0)") * v.cast("decimal(19,0)"))
    deviation = F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda a, b: (a + b).cast("decimal(38,0)"))
    shares = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values])
    result = rows.select("id", "index", deviation.try_cast("long").alias("deviation")).join(whitened, F.col("index") == F.col("at"))
    result = result.select("id", "deviation", F.posexplode("w").alias("pos", "whitened"))
    return result.select(
        F.col("id").alias("vec_id"),
        (F.col("pos") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
