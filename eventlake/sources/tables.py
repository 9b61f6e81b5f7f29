"""Table scans and writes shared by the layers (Parquet datasets on shared storage)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: the partition directory of rows without a value
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
WRITE_MODES = frozenset({"append", "overwrite"})


def check_mode(mode: str) -> str:
    """The write modes whose reruns are defined here; any other is an error."""
    if mode in WRITE_MODES:
        return mode
    raise ValueError(f"unsupported write mode {mode!r}: use one of {sorted(WRITE_MODES)}")


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Scan a Parquet dataset; with ``schema`` no footer-merging job runs and
    columns missing from older files read as NULL."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable dataset (uses the Hadoop FS of the path)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    dynamic_overwrite: bool = True,
    count_into: Observation | None = None,
) -> None:
    """Write a Parquet dataset.

    * ``partition_by``: Hive-style directories, read back with partition pruning.
    * ``rebalance``: add a ``REBALANCE`` on the partition columns so AQE sizes
      the output files (splitting a large day and merging small ones) instead of
      every task writing one file into every directory.
    * ``dynamic_overwrite``: an overwrite replaces only the partitions present
      in ``df`` -- reruns of some days leave the other days untouched.
    * ``count_into``: observe the written row count (metric ``rows``) in the
      final write stage, where each partition's update is applied once even
      when tasks are retried.
    """
    check_mode(mode)
    out = df
    if rebalance and partition_by:
        out = out.hint("rebalance", *partition_by)
    if count_into is not None:
        out = out.observe(count_into, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            # explicit either way, so a session-wide setting cannot change it
            writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic_overwrite else "static")
    writer.parquet(path)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Remove the directories of some partition values, if they exist."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in values:
        fs.delete(hadoop.Path(root, f"{column}={value}"), True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column that have a directory (the null directory left out); one listing, no job."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    glob = hadoop.Path(f"{path.rstrip('/')}/{column}=*")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or []
    values = sorted(str(f.getPath().getName()).split("=", 1)[1] for f in found)
    return [v for v in values if v != HIVE_NULL]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a marker."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True).close()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a dataset that the caller itself has written."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace_days(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    days: Sequence[str] | None,
    rebalance: bool = False,
    column: str = "event_date",
) -> int:
    """Make ``path`` hold exactly ``df`` for ``days`` (``None``: as a whole); returns the rows written.

    A dynamic overwrite replaces only partitions that have rows. Which days were
    written is observed in the write itself, and the directories of the other
    requested days are removed after it, so a day that lost its rows is empty.
    """
    seen = Observation(f"days-{uuid.uuid4().hex[:8]}")
    out = df.hint("rebalance", column) if rebalance else df
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.coalesce(F.col(column).cast("string"), F.lit(HIVE_NULL))).alias("days"))
    mode = "static" if days is None else "dynamic"
    out.write.mode("overwrite").partitionBy(column).option("partitionOverwriteMode", mode).parquet(path)
    got = seen.get
    if days is not None:
        drop_partitions(spark, path, column, sorted({str(d) for d in days} - set(got.get("days") or [])))
    return int(got.get("rows") or 0)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE TEMP VIEW name`` over ``df``; returns ``df``."""
    df.createOrReplaceTempView(name)
    return df


def write_report(df: DataFrame, path: str) -> None:
    """Append a (small) result DataFrame as JSON lines, e.g. quality results."""
    df.coalesce(1).write.mode("append").json(path)
