"""Physical layout helpers: partitioned writes, multi-file clustering, joins.

* :func:`write_partitioned` -- directory per value; a filter on the column
  becomes ``PartitionFilters`` and unread directories are never listed.
* :func:`cluster_by` -- rewrite so each file covers a narrow key range; the
  Parquet footers' min/max then let a point lookup skip most files and row
  groups. One column: range partitioning + sort. Several columns: a Z-order
  code from quantile buckets interleaved bit by bit.
* :func:`write_bloom` -- Bloom filters for lookups on columns the layout is not
  clustered by; :func:`write_bucketed` / :func:`join_bucketed` -- tables dealt by
  their join key, joined without a shuffle.
* :func:`join_dim` -- broadcast a dimension only after one bounded scan
  proves its row count and byte size small; otherwise a shuffle join (AQE may
  still re-plan and split skewed partitions), or an explicitly salted join
  for known hot keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from eventlake.sources.tables import write_table

#: Default broadcast row bound: a dimension up to this many rows may be broadcast.
BROADCAST_MAX_ROWS = 2_000_000


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("event_date",), mode: str = "overwrite") -> None:
    write_table(df, path, mode=mode, partition_by=tuple(by), rebalance=True)


def write_flat(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_table(df, path, mode=mode)


def _numeric(df: DataFrame, col: str) -> Column:
    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(t, NumericType):
        return c.cast("double")
    raise TypeError(f"cluster_by supports numeric, date and timestamp columns, not {t.simpleString()} ({col})")


def zorder_code(df: DataFrame, cols: Sequence[str], bits: int = 10, relative_error: float = 0.001) -> DataFrame:
    """Add ``_zorder``: each column mapped to a quantile bucket in
    ``[0, 2**bits)`` and the bucket bits interleaved, most significant first.

    The split points of all columns come from one distributed
    ``approxQuantile`` pass (``2**bits`` numbers per column reach the driver);
    a ``Bucketizer`` then assigns buckets by binary search on the executors.
    """
    k = len(cols)
    if k == 0:
        raise ValueError("zorder_code needs at least one column")
    bits = min(bits, 62 // k)  # the interleaved code must fit a signed 64-bit long
    nums = [f"_zn{i}" for i in range(k)]
    buckets = [f"_zb{i}" for i in range(k)]
    tmp = df.withColumns({n: _numeric(df, c) for n, c in zip(nums, cols)})
    probs = [i / 2**bits for i in range(1, 2**bits)]
    quantiles = tmp.approxQuantile(nums, probs, relative_error)
    splits = []
    for q in quantiles:
        inner = sorted(set(q))  # a hot value repeats; splits must strictly increase
        splits.append([-math.inf, *inner, math.inf])
    tmp = Bucketizer(splitsArray=splits, inputCols=nums, outputCols=buckets, handleInvalid="keep").transform(tmp)
    code: Column = F.lit(0).cast("long")
    for bit in range(bits):
        for j, b in enumerate(buckets):
            # bit `bit` of column j goes to position bit*k + j of the code
            code = code.bitwiseOR(F.shiftleft(F.shiftright(F.col(b).cast("long"), bit).bitwiseAND(F.lit(1)), bit * k + j))
    return tmp.withColumn("_zorder", code).drop(*nums, *buckets)


def cluster_by(df: DataFrame, cols: Sequence[str], n_files: int) -> DataFrame:
    """Lay ``df`` out so that each of ``n_files`` output partitions holds a
    contiguous key range (sorted inside), ready to be written.

    The range bounds are sampled on (key, hash of the row): a key holding a
    large share of the rows is then split over several consecutive files
    (each still covering one narrow key range) instead of landing in one
    oversized task. The hash is deterministic, so a retried task routes every
    row exactly as before.
    """
    cols = list(cols)
    if not cols:
        raise ValueError("cluster_by needs at least one column")
    spread = F.xxhash64(*[F.col(c) for c in df.columns]).alias("_spread")
    if len(cols) == 1:
        key = F.col(cols[0])
        return (
            df.withColumn("_spread", spread)
            .repartitionByRange(n_files, key, F.col("_spread"))
            .sortWithinPartitions(cols[0])
            .drop("_spread")
        )
    z = zorder_code(df, cols).withColumn("_spread", spread)
    return (
        z.repartitionByRange(n_files, F.col("_zorder"), F.col("_spread"))
        .sortWithinPartitions("_zorder")
        .drop("_zorder", "_spread")
    )


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], n_files: int, mode: str = "overwrite") -> None:
    write_table(cluster_by(df, cols, n_files), path, mode=mode)


#: Target size of a clustered output file.
TARGET_FILE_BYTES = 256 * 1024 * 1024


def table_bytes(spark: SparkSession, path: str) -> int:
    """On-disk size of a dataset (one content-summary call on its file system)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def optimize_table(
    spark: SparkSession,
    src_path: str,
    dst_path: str,
    cols: Sequence[str],
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Rewrite the Parquet table at ``src_path`` clustered by ``cols`` into
    ``dst_path`` with about ``target_file_bytes`` per file; returns the number
    of files. (Reading and overwriting one path in the same job is not
    possible with plain Parquet, hence the separate destination.)"""
    n_files = max(1, math.ceil(table_bytes(spark, src_path) / target_file_bytes))
    write_clustered(spark.read.parquet(src_path), dst_path, cols, n_files)
    return n_files


#: Default broadcast byte bound (measured payload of the dimension's rows).
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

_FIXED_WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
    "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: fixed widths plus the actual string/binary lengths."""
    total: Column = F.lit(0).cast("long")
    fixed = 0
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        if name in _FIXED_WIDTH:
            fixed += _FIXED_WIDTH[name]
        elif name in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long")
        else:  # nested / decimal: measure the JSON text as an upper-side estimate
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)).cast("long")
    return total + F.lit(fixed)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows whose values total at most
    ``max_bytes``: one aggregate, of which each task sends one row."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def hot_keys(fact: DataFrame, on: str, hot_share: float) -> DataFrame:
    """Keys that hold at least ``hot_share`` of the rows of ``fact`` (partial
    aggregation first, so counting a hot key is itself cheap). At most
    ``1 / hot_share`` keys qualify, whatever the size of the table."""
    least = max(1, math.ceil(fact.count() * hot_share))
    return fact.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= F.lit(least)).select(on)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "inner",
    buckets: int = 32,
    hot_share: float | None = None,
) -> DataFrame:
    """Shuffle join that spreads hot keys over ``buckets`` reducers.

    Fact rows get a salt from a hash of the row and its map partition;
    dimension rows are replicated once per salt, so any salt finds its match.
    With ``hot_share`` only keys holding at least that share of the fact are
    salted: they are marked by a join with :func:`hot_keys`, a table of at most
    ``1 / hot_share`` rows that is broadcast for that reason. NULL keys match
    nothing and are spread as well. Without ``hot_share`` every key is salted.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    # salt from the row's content and its map partition: identical copies of
    # one row (e.g. replays) still spread, and a retried map task, reading the
    # same split under the same partition id, salts every row as before
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns], F.spark_partition_id()), F.lit(buckets)).cast("int")
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    if hot_share is None:
        salted_fact = fact.withColumn("_salt", salt)
        salted_dim = dim.withColumn("_salt", F.explode(every))
    else:
        hot = F.broadcast(hot_keys(fact, on, hot_share).withColumn("_hot", F.lit(True)))
        spread = F.col("_hot").isNotNull() | F.col(on).isNull()
        salted_fact = fact.join(hot, on, "left").withColumn("_salt", F.when(spread, salt).otherwise(F.lit(0))).drop("_hot")
        copies = F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0)))
        salted_dim = dim.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_fact.join(salted_dim.hint("merge"), [on, "_salt"], how).drop("_salt")


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    strategy: str = "auto",
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
    salt_buckets: int = 32,
    hot_share: float | None = None,
) -> DataFrame:
    """Join a fact with a dimension.

    ``strategy``:

    * ``broadcast`` -- broadcast hint if :func:`fits_broadcast` proves the
      dimension small, the plain join of ``auto`` if not;
    * ``shuffle``   -- sort-merge join (AQE still splits skewed partitions);
    * ``salted``    -- :func:`salted_join` (only keys holding ``hot_share`` of
      the fact are salted when it is given);
    * ``auto``      -- a plain join: Catalyst broadcasts when its size
      estimate is under ``autoBroadcastJoinThreshold`` and AQE re-plans from
      the measured shuffle sizes at runtime (no extra pass over the dimension).

    The explicit probe of ``broadcast`` reads the dimension once more, so pass
    a materialised dimension (a written table), as the Gold build does.
    """
    if strategy not in ("auto", "broadcast", "shuffle", "salted"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    if strategy == "shuffle":
        return fact.join(dim.hint("merge"), on, how)
    if strategy == "salted":
        if not isinstance(on, str):
            raise ValueError("salted join takes one key column")
        return salted_join(fact, dim, on, how, salt_buckets, hot_share)
    if strategy == "broadcast" and fits_broadcast(dim, max_broadcast_rows, max_broadcast_bytes):
        return fact.join(F.broadcast(dim), on, how)
    return fact.join(dim, on, how)


def write_bloom(df: DataFrame, path: str, columns: Sequence[str], distinct_per_group: int = 1_000_000, row_group_bytes: int | None = None) -> None:
    """Write Parquet with a Bloom filter of some columns in every row group.

    A point lookup on such a column skips the row groups that don't hold the
    value, also where the table is not clustered by it and every row group's
    range spans the value. ``distinct_per_group``: distinct values expected in a
    row group; it sets the size of the filter (about a byte and a half each).
    """
    writer = df.write.mode("overwrite")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct_per_group))
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table of the session catalog, dealt to ``buckets`` by a hash of ``key`` and sorted by it.

    Two tables with equal buckets of the join key are joined without a shuffle of
    either. ``path``: a folder on shared storage. One file per bucket and task, so
    the rows are first dealt out as the buckets are.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def join_bucketed(fact: DataFrame, dim: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Sort-merge join of two tables of :func:`write_bucketed`: bucket by bucket, no exchange."""
    return fact.join(dim.hint("merge"), on, how)
