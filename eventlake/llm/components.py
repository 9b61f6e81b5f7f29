"""Connected components of a link table, by alternating large-star and small-star.

Every round is a grouped minimum and a join, written to the shared scratch
folder, so neither links nor labels meet in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.session import scratch_dir


#: shuffle files of a job go when it ends, instead of when the driver's JVM happens to collect garbage
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, compression: str | None = None, schema: StructType | str | None = None, free: bool = False) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its lineage ends there. ``schema``: read it as these columns.

    ``free``: its shuffle files are removed when the table stands.
    """
    spark = df.sparkSession
    at, before = scratch_dir(spark, name), spark.conf.get(_FREE, None)
    if free:
        spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(at, compression=compression)
    finally:
        if free and before is None:
            spark.conf.unset(_FREE)
        elif free:
            spark.conf.set(_FREE, before)
    return spark.read.schema(schema or df.schema).parquet(at)


def remove(table: DataFrame) -> None:
    """Delete a table of :func:`written` that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in links (a, b): the smallest node it is connected with."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", free=True)
    state = None
    while True:
        # large star: each node's larger neighbours point at its least neighbour (or itself)
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: each node and its smaller neighbours point at the least of these
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        last, edges = edges, written(small.distinct(), "links", free=True)
        remove(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(edges.select("b", "b").distinct())
