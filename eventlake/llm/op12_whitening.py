"""Embedding whitening with distributed block matrices (Spark MLlib BlockMatrix).

Entries become the integers floor(64 c) + 1000000. The distinct integer vectors
(the fit list) get dense row numbers, are centred and dealt into blocks of
``ROWS`` rows; a block is one row of a written table that MLlib reads as its
matrices. Block rows stand in ``lanes``: the matrix is block-sparse, lane k
having its own column block, so a product of it with its transpose or with the
whitening matrix (repeated for each lane) is spread over lanes x splits tasks of
a few blocks each, instead of one task for a tall matrix. The sum of the lanes'
scatter matrices (dimension squared) goes to the driver for ``eigh``; the block
product with the components over the root of their variance projects the rows.

Sums are exact integers and vectors are centred as (n x - S) / n, so only the
products round.

Rows whose vector is null or holds null or non-finite entries (or ones of which
64 c is no long) are left out. Shorter vectors count as padded with zeros, empty
ones are zeros. Rows that repeat, also with null or equal ids, are returned one
by one and count once in the fit list. A component without variance has whitened
and explained 0 and is left out of identity_error. ``deviation`` is NULL where it
does not fit in a long. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventlake.llm.components import written
from eventlake.session import scratch_dir

SCALE, SHIFT, COMPONENTS, ROWS = 64, 1_000_000, 16, 1024
#: lanes of block rows at most (the number of tasks grows with their square)
LANES = 1024
#: variance of a component, as a share of the whole, that is nothing but rounding
NOTHING = 1e-13
_MATRIX = "struct<type: tinyint, numRows: int, numCols: int, colPtrs: array<int>, rowIndices: array<int>, values: array<double>, isTransposed: boolean>"
_AT = StructType([StructField("_1", LongType()), StructField("_2", LongType())])
_BLOCKS = StructType([StructField("_1", _AT), StructField("_2", MatrixUDT())])
_PLAIN = f"_1 struct<_1: bigint, _2: bigint>, _2 {_MATRIX}"


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows whose vector has finite entries only."""
    wide = F.transform("embedding", lambda c: c.cast("double") * SCALE)
    # NaN counts as larger than any number
    x = F.transform(wide, lambda v: F.floor(F.when(F.abs(v) < 9.0e18, v)) + F.lit(SHIFT))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    return rows.where(F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull()))


def _numbered(fit: DataFrame) -> DataFrame:
    """The written fit list (x, place) with dense row numbers (``row``); one number per partition passes the driver."""
    part = F.shiftright("place", 33)
    counts = sorted((r.part, r.n) for r in fit.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts, at = [], 0
    for p, n in counts:
        starts.append((p, at))
        at += n
    first = fit.sparkSession.createDataFrame(starts, "part long, first long")
    # a row per partition
    return fit.join(F.broadcast(first), part == F.col("part")).select("x", (F.col("first") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("row"))


def _blocks(lane_rows: int, dim: int):
    def fn(key, table):
        """The rows of one block as a matrix, in column-major order; rows beyond the last are zero."""
        block = key[0].as_py()
        rows = table["row"].to_numpy() - block * ROWS
        m = np.zeros((ROWS, dim))
        m[rows] = table["c"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        at = pa.array([{"_1": block, "_2": block // lane_rows}], pa.struct([("_1", pa.int64()), ("_2", pa.int64())]))
        ints = pa.list_(pa.int32())
        kind = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", ints), ("rowIndices", ints), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])
        values = pa.ListArray.from_arrays(pa.array([0, m.size], pa.int32()), pa.array(m.ravel(order="F")))
        arrays = [pa.array([1], pa.int8()), pa.array([ROWS], pa.int32()), pa.array([dim], pa.int32()), pa.array([None], ints), pa.array([None], ints), values, pa.array([False])]
        return pa.table({"_1": at, "_2": pa.StructArray.from_arrays(arrays, fields=list(kind))})

    return fn


def _read_blocks(spark: SparkSession, path: str, n_blocks: int, lanes: int, dim: int) -> BlockMatrix:
    """The written blocks as a matrix; the column is read in the type that MLlib has for it."""
    df = spark.read.schema(_BLOCKS).parquet(path)
    java = callMLlibFunc("createBlockMatrix", df, ROWS, dim, n_blocks * ROWS, lanes * dim)
    return BlockMatrix(java, ROWS, dim)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a x b, where the blocks of the inner dimension are dealt to ``splits`` tasks for each part of the result."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def _rows_of(k: int):
    def fn(batches):
        for batch in batches:
            at, block = batch.column("_1").field("_1").to_pylist(), batch.column("_2")
            rows, values = block.field("numRows").to_pylist(), block.field("values")
            turned = block.field("isTransposed").to_pylist()
            for i, first in enumerate(at):
                v = values[i].values.to_numpy()
                m = v.reshape(rows[i], k) if turned[i] else v.reshape(k, rows[i]).T
                w = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(m).ravel()), k).cast(pa.list_(pa.float64()))
                yield pa.record_batch({"row": pa.array(first * ROWS + np.arange(rows[i])), "w": w})

    return fn


def _moments(k: int):
    """Sums of products of each pair of components, one table per task."""

    def fn(batches):
        total = np.zeros((k, k))
        for batch in batches:
            values, rows, turned = (batch.column("_2").field(c) for c in ("values", "numRows", "isTransposed"))
            for v, r, t in zip(values, rows.to_pylist(), turned.to_pylist(), strict=True):
                m = v.values.to_numpy()
                m = m.reshape(r, k).T if t else m.reshape(k, r)
                total += m @ m.T
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.record_batch({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(total.ravel())})

    return fn


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened array<double>, explained array<double>, identity_error of every usable row."""
    spark = embeddings.sparkSession
    out = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    rows = integers(embeddings)
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not dim:  # no usable row, or only vectors without entries: they have no component
        return spark.createDataFrame([], out)
    pad = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dim) - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", pad))
    fit = written(rows.select("x").distinct().withColumn("place", F.monotonically_increasing_id()), "whitening-fit")
    sums = {r.i: (r.s, r.n) for r in fit.select(F.posexplode(F.transform("x", lambda v: v - SHIFT)).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"), F.count("v").alias("n")).collect()}
    n, total = sums[0][1], F.lit([sums[i][0] for i in range(dim)]).cast("array<long>")
    apart = F.zip_with("x", total, lambda v, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), v - SHIFT), s))
    squares = F.aggregate(F.transform(apart, lambda v: F.try_multiply(v, v)), F.lit(0).cast("long"), lambda a, v: F.try_add(a, v))
    # beyond longs the centred value is taken in double precision
    centred = F.zip_with(apart, F.zip_with("x", total, lambda v, s: (v - SHIFT).cast("double") - s / F.lit(float(n))), lambda v, d: F.coalesce(v / F.lit(float(n)), d))
    numbered = written(_numbered(fit).withColumns({"c": centred, "deviation": squares}), "whitening-rows")

    n_blocks = math.ceil(n / ROWS)
    lanes = min(LANES, math.ceil(math.sqrt(n_blocks)))
    lane_rows = math.ceil(n_blocks / lanes)
    grouped = numbered.select("row", "c").groupBy(F.expr(f"row div {ROWS}").alias("block"))
    at = scratch_dir(spark, "whitening-blocks")
    grouped.applyInArrow(_blocks(lane_rows, dim), _PLAIN).write.parquet(at)
    a = _read_blocks(spark, at, n_blocks, lanes, dim)

    # only lane k with lane k gives a block: the lanes' scatter matrices stand on the diagonal
    scatter = _times(a.transpose(), a, lanes).blocks.map(lambda b: b[1].toArray()).treeReduce(np.add)
    variance, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    k, whole = min(components, dim), float(np.trace(scatter) / n)
    variance, vectors = variance[::-1][:k], vectors[:, ::-1][:, :k]
    real = variance > NOTHING * whole
    spread = np.where(real, 1 / np.sqrt(np.where(real, variance, 1)), 0.0)
    matrix = Matrices.dense(dim, k, (vectors * spread).ravel(order="F").tolist())
    w = BlockMatrix(spark.sparkContext.parallelize([((lane, 0), matrix) for lane in range(lanes)]), dim, k, lanes * dim, k)
    projected = _times(a, w, lanes)
    done = written(callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model), "whitening-projected", schema=_PLAIN)

    moments = np.zeros((k, k))
    for r in done.mapInArrow(_moments(k), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        moments[r.i, r.j] = r.v / n
    off = np.abs(moments - np.eye(k))[np.ix_(real, real)]
    share = np.where(real, variance, 0.0) / whole if whole > 0 else np.zeros(k)
    of_x = numbered.join(done.mapInArrow(_rows_of(k), "row long, w array<double>"), "row").select("x", "deviation", F.col("w").alias("whitened"))
    # one row of the fit list for each x; rows that share it are split by the adaptive join
    return rows.join(of_x, "x").select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.lit(share.tolist()).cast("array<double>").alias("explained"),
        F.lit(float(off.max()) if off.size else 0.0).alias("identity_error"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding, one row per component."""
    done = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    each = done.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c"))
    return each.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
