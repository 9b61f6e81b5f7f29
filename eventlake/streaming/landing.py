"""Landing as a Structured Streaming job.

The file source remembers which dump files it has processed in its
checkpoint, so the checkpoint *is* the ledger: each run with
``trigger(availableNow=True)`` lands exactly the files that arrived since the
last run, then stops. The Parquet sink commits each micro-batch atomically
through its own metadata log, so a crashed run resumes without duplicates.

Readers of a path written by this sink list files through that log
(``_spark_metadata``), so do not also append to it with the batch ``land``:
batch-written files would be invisible to them. Use one form per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlake.plans.medallion import LakePaths, bronze_to_silver
from eventlake.schema import BRONZE_SCHEMA
from eventlake.session import checkpoint_dir
from eventlake.sources.bronze import parse_lines, with_ingest_columns
from eventlake.sources.tables import table_exists


def read_dump_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of ``raw_dir`` for ``*.json.gz`` dumps, read as the batch landing does."""
    reader = spark.readStream.option("pathGlobFilter", "*.json.gz")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_lines(reader.text(raw_dir))


def start_landing(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint_path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` landing query into a date-partitioned Bronze."""
    ckpt = checkpoint_path or f"{checkpoint_dir(spark).rstrip('/')}/eventlake-landing"
    events = with_ingest_columns(read_dump_stream(spark, raw_dir, max_files_per_trigger))
    return (
        events.writeStream.format("parquet")
        .option("path", bronze_path)
        .option("checkpointLocation", ckpt)
        .partitionBy("event_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def land_available(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint_path: str | None = None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Land every dump not yet seen by the checkpoint; return rows landed.

    The rows are counted in the sink's committed files (Parquet footers), before
    and after: progress events of a long run are not all kept. The stream must
    be the only writer of its table.
    """
    before = _rows(spark, bronze_path)
    q = start_landing(spark, raw_dir, bronze_path, checkpoint_path, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _rows(spark, bronze_path) - before


def _rows(spark: SparkSession, path: str) -> int:
    return spark.read.schema(BRONZE_SCHEMA).parquet(path).count() if table_exists(spark, path) else 0


def bronze_stream_to_silver(spark: SparkSession, paths: LakePaths, checkpoint_path: str | None = None) -> StreamingQuery:
    """Incremental Bronze -> Silver: each micro-batch rebuilds the days it has rows of.

    The days come from the new files, the rows of those days from Bronze as a
    whole, through the batch job: late dumps of any age are merged, replays are
    deduplicated as in the batch form, nothing is dropped for being old, and no
    state is kept beside the tables. A batch that fails is run again and gives
    the same tables.
    """
    ckpt = checkpoint_path or f"{checkpoint_dir(spark).rstrip('/')}/eventlake-silver"

    def merge(batch: DataFrame, _: int) -> None:
        days = [r.event_date for r in batch.select("event_date").distinct().collect()]  # one row per day
        if days:
            bronze_to_silver(batch.sparkSession, paths, sorted(d for d in days if d is not None))

    stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(paths.bronze)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
