"""Embedding near-dedup by an exact metric range join.

Cosine >= t between unit vectors is a Euclidean distance <= eps = sqrt(2 - 2t).
Pivots (vectors of the data) partition the vectors: each belongs to the cell of
its nearest pivot. By the triangle inequality a vector can only be within eps of
some vector of cell p if it lies within eps of the plane between its own pivot
and p; such vectors are replicated to p as guests. Cells join independently, and
each finds all links of its own vectors. Cells and their guests are split into
parts of bounded size, so a cell that a third of all vectors share is many tasks.

Equal vectors are compared once, as one class with a count. Candidates from a
single-precision product are decided by the cosine in double precision. The
number of pivots changes the cost only, never the result.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing (n_links 0, their own component); shorter vectors count as padded
with zeros. Vectors of any length are compared, as cosine does not depend on it. Rows without vec_id are left out; rows that repeat a vec_id with the
same vector count as one, with different vectors as a link's two ends.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.components import components, written

LEAST = 0.95
#: rows of a cell's part, of a part's guests, and the largest number of pivots
PART, GUESTS, PIVOTS = 8192, 16384, 256
_SLACK = 1e-4


def _matrix(column, dim: int) -> np.ndarray:
    """Rows of a list column in double precision, padded with zeros; each scaled by the power of two that brings
    its largest component to between a half and one, so that squares neither overflow nor vanish."""
    size = t.lengths(column)
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(size), dim))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return np.ldexp(out, -np.frexp(np.abs(out).max(1, initial=0.0))[1][:, None])


def _norm(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m))


def _cells(pivots: np.ndarray, eps: float, kind: str):
    """Each vector once for its own cell (home) and once for every cell whose vectors can be within eps."""
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))

    def fn(batches):
        for batch in batches:
            m = _matrix(batch.column("embedding"), pivots.shape[1])
            unit = m / _norm(m)[:, None]
            cos = unit @ pivots.T
            home = cos.argmax(1)
            near = (cos[np.arange(len(m)), home][:, None] - cos) <= (eps + 1e-9) * apart[home] + 1e-9
            near[np.arange(len(m)), home] = True
            row, cell = np.nonzero(near)
            take = pa.array(row)
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(take), "n": batch.column("n").take(take), "embedding": batch.column("embedding").take(take),
                "cell": pa.array(cell.astype(np.int32)), "home": pa.array(home[row] == cell),
            })

    return fn, f"vec_id long, n long, embedding {kind}, cell int, home boolean"


def _link(dim: int, least: float):
    """Of one part of a cell and one part of its guests: links of each own vector, and everyone's smallest connected id."""

    def fn(table):
        ids, n = t.ids(table["vec_id"]), t.ids(table["n"])
        mine = table["home"].to_numpy().astype(bool)
        m = _matrix(table["embedding"], dim)
        norm = _norm(m)
        unit = (m / norm[:, None]).astype(np.float32)
        own, other = np.flatnonzero(mine), np.flatnonzero(~mine)
        links = np.zeros(len(ids), np.int64)
        ends: list[np.ndarray] = []
        for a in range(0, len(own), 1024):
            rows = own[a : a + 1024]
            for b in range(0, len(other), 4096):
                cols = other[b : b + 4096]
                i, j = np.nonzero(unit[rows] @ unit[cols].T >= least - _SLACK)
                i, j = rows[i], cols[j]
                for c in range(0, len(i), 1 << 16):
                    x, y = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
                    ok = (np.einsum("ij,ij->i", m[x], m[y]) / (norm[x] * norm[y]) >= least) & (ids[x] != ids[y])
                    x, y = x[ok], y[ok]
                    np.add.at(links, x, n[y])
                    # a spanning forest is enough for the components
                    ends.append(_forest(x, y, ids))
        label = _labels(ends, ids)
        tell = mine | (label < ids)
        return pa.table({"vec_id": pa.array(ids[tell]), "links": pa.array(links[tell]), "label": pa.array(label[tell])})

    return fn


def _spread(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> np.ndarray:
    label = ids.copy()
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        if (new == label).all():
            return label
        label = new


def _forest(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of the links (x, y): one from each vector to one with its component's smallest id."""
    if len(x) == 0:
        return np.zeros((0, 2), np.int64)
    label = _spread(x, y, ids)
    seen = np.unique(np.concatenate([x, y]))
    by_id = seen[np.argsort(ids[seen], kind="stable")]
    return np.stack([seen, by_id[np.searchsorted(ids[by_id], label[seen])]], 1)


def _labels(ends: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
    pairs = np.concatenate(ends) if ends else np.zeros((0, 2), np.int64)
    return _spread(pairs[:, 0], pairs[:, 1], ids)


def near_vectors(vectors: DataFrame, least: float = LEAST, part: int = PART, guests: int = GUESTS, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    every = vectors.where("vec_id is not null").select("vec_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = every.where(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    classes = written(usable.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.countDistinct("vec_id").alias("n")), "vector-classes")
    size, dim = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if size:
        wanted = min(pivots, math.ceil(size / part))
        chosen = classes.orderBy(F.xxhash64("embedding"), "vec_id").limit(wanted).select("embedding").toArrow()
        p = _matrix(chosen["embedding"], dim)
        fn, schema = _cells(p / _norm(p)[:, None], math.sqrt(2 - 2 * least), kind)
        cells = classes.select("vec_id", "n", "embedding").mapInArrow(fn, schema)
        sizes = cells.groupBy("cell").agg(F.count("*").alias("all"), F.sum(F.col("home").cast("long")).alias("own"))
        parts = F.broadcast(sizes.select("cell", F.ceil(F.col("own") / part).cast("int").alias("n_parts"), F.ceil(F.col("all") / guests).cast("int").alias("n_guests")))  # a row per pivot
        h = F.xxhash64("vec_id", "embedding")
        dealt = cells.join(parts, "cell").where("n_parts > 0")
        own = dealt.where("home").withColumn("a", F.pmod(h, "n_parts")).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("n_guests") - 1)))
        guest = dealt.withColumn("home", F.lit(False)).withColumn("b", F.pmod(h, "n_guests")).withColumn("a", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        columns = ["vec_id", "n", "embedding", "cell", "home", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b")]
        found = own.select(*columns).unionAll(guest.select(*columns)).groupBy("cell", "a", "b").applyInArrow(_link(dim, least), "vec_id long, links long, label long")
        found = written(found, "vector-links")
        labels = components(found.where("label < vec_id").select(F.col("vec_id").alias("a"), F.col("label").alias("b")))
        links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
        told = classes.join(links, "vec_id", "left").join(labels, classes.vec_id == labels.node, "left")
        told = told.select(F.col("embedding").alias("vector"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "vec_id").alias("component_id"))
        out = every.join(told, every.embedding == told.vector, "left")
    else:
        out = every.withColumn("n_links", F.lit(0)).withColumn("component_id", F.lit(None).cast("long"))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op7_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
