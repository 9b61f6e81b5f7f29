"""Raw hourly dumps -> Bronze.

A dump is one gzipped JSON-lines file per hour named ``YYYY-MM-DD-H.json.gz``
(hour not zero-padded). Landing reads the files with an explicit envelope
schema (no inference job), stamps ``event_date`` / ``_ingested_at``, and
appends to a Parquet dataset partitioned by ``event_date``. A ledger of
landed files makes reruns skip what is already in, and an hour grid tells
which hours a range must have.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType, VariantType

from eventlake.functions.columns import parse_timestamp
from eventlake.schema import BRONZE_SCHEMA, CORRUPT_COLUMN, FURTHER_COLUMN, RAW_READ_SCHEMA, RAW_SCHEMA
from eventlake.sources.tables import check_mode, table_exists, write_table

LEDGER_SCHEMA = "file_path string, file_name string, landed_at timestamp"


#: key of ``further`` for a whole line whose members can't be told apart
WHOLE_LINE = ""


def _members_beyond(line: Column, corrupt: Column) -> Column:
    """Members of a JSON line that the envelope has no column for, as variants.

    Those of a nested envelope object stand under its name (``actor`` holds what
    else the actor has). A line with repeated members, or with a value no variant
    can hold, is kept whole under the key :data:`WHOLE_LINE`; one that is in
    ``_corrupt_record`` already has none.
    """
    kind = MapType(StringType(), VariantType())
    members = F.from_json(line, kind)

    def beyond(members: Column, known: list[str]) -> Column:
        return F.map_filter(members, lambda k, _: ~k.isin(known))

    parts = [beyond(members, RAW_SCHEMA.fieldNames())]
    none = F.create_map().cast(kind)
    for f in RAW_SCHEMA.fields:
        if isinstance(f.dataType, StructType):
            rest = beyond(members[f.name].try_cast(kind), f.dataType.fieldNames())
            parts.append(F.when(F.size(rest) > 0, F.create_map(F.lit(f.name), F.to_variant_object(rest))).otherwise(none))
    told_apart = F.size(F.array_distinct(F.map_keys(members))) == F.size(members)
    whole = F.create_map(F.lit(WHOLE_LINE), line.cast(VariantType()))
    return F.when(corrupt.isNull(), F.when(told_apart, F.map_concat(*parts)).otherwise(whole))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Raw envelope of text lines (column ``value``); further members stand in ``further``.

    Blank lines are no records. A line that is no JSON object, or whose members
    have other shapes, is kept in ``_corrupt_record`` with what could be read.
    """
    envelope = StructType([f for f in RAW_READ_SCHEMA.fields if f.name != FURTHER_COLUMN])
    parsed = F.from_json("value", envelope, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    rows = lines.where(F.trim("value") != "").select(parsed.alias("e"), "value")
    return rows.select("e.*", _members_beyond(F.col("value"), F.col(f"e.{CORRUPT_COLUMN}")).alias(FURTHER_COLUMN))


def new_members(bronze: DataFrame) -> DataFrame:
    """Members beyond the envelope: ``member, value_type, first_day, n_rows``, one row each.

    Types of different dumps are merged as numbers widen and objects grow;
    ``VARIANT`` is what has no common type.
    """
    each = bronze.select("event_date", F.explode(FURTHER_COLUMN).alias("member", "value"))
    return each.groupBy("member").agg(
        F.schema_of_variant_agg("value").alias("value_type"),
        F.min("event_date").alias("first_day"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def with_members(bronze: DataFrame, columns: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """Bronze with further members as typed columns: name -> (member, path in it, type); NULL where absent or of another type."""
    return bronze.withColumns({name: F.try_variant_get(F.col(FURTHER_COLUMN)[member], path, kind) for name, (member, path, kind) in columns.items()})


def read_events(spark: SparkSession, paths: Sequence[str], infer: bool = False) -> DataFrame:
    """Scan raw dump files (gzip is detected by extension).

    No inference pass runs: see :func:`parse_lines`. ``infer=True`` reads the
    files through Spark's schema inference instead (one extra scan).
    """
    files = [str(p) for p in paths]
    if not files:
        raise ValueError("no dump files to read")
    return spark.read.json(files) if infer else parse_lines(spark.read.text(files))


def with_ingest_columns(df: DataFrame, ingested_at: dt.datetime | None = None) -> DataFrame:
    """The day that a row is filed under and its load time, as two more columns.

    ``ingested_at`` pins the load time (repeatable runs); default is the query
    start time.
    """
    created = parse_timestamp(F.col("created_at"), df.schema["created_at"].dataType)
    loaded: Column = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    return df.withColumns({"event_date": F.to_date(created), "_ingested_at": loaded})


def write_bronze(df: DataFrame, table_path: str, mode: str = "append") -> None:
    """Write rows that have their day into the day directories of Bronze.

    Rows stay in their tasks: an hourly dump is one (unsplittable) gzip file, so each
    task already writes its hour into one date directory.
    """
    check_mode(mode)
    write_table(df, table_path, mode=mode, partition_by=("event_date",), dynamic_overwrite=False)


def read_bronze(spark: SparkSession, table_path: str) -> DataFrame:
    """Landed Bronze with its contract schema; new members of a dump are in ``further``."""
    return spark.read.schema(BRONZE_SCHEMA).parquet(table_path)


def read_bronze_merged(spark: SparkSession, table_path: str) -> DataFrame:
    """Bronze written by hand with columns of its own: all footers are merged."""
    return spark.read.option("mergeSchema", "true").parquet(table_path)


# ---------------------------------------------------------------------------
# ledger of landed files
# ---------------------------------------------------------------------------


def file_listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    rows = [(str(p), str(p).rstrip("/").rsplit("/", 1)[-1]) for p in paths]
    return spark.createDataFrame(rows, "file_path string, file_name string")


def pending_files(spark: SparkSession, paths: Sequence[str], ledger_path: str | None) -> DataFrame:
    """Files of ``paths`` that the ledger has not recorded as landed."""
    listing = file_listing(spark, paths)
    if not ledger_path or not table_exists(spark, ledger_path):
        return listing
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).select("file_path")
    return listing.join(ledger, "file_path", "left_anti")


@dataclass(frozen=True)
class LandResult:
    rows: int
    files: tuple[str, ...]


def land(
    spark: SparkSession,
    paths: Sequence[str],
    bronze_path: str,
    ledger_path: str | None = None,
    mode: str = "append",
    ingested_at: dt.datetime | None = None,
) -> LandResult:
    """Land raw dump files into Bronze in one pass and return the rows written.

    ``append`` (default): with ``ledger_path`` files landed before are
    skipped; the ledger is appended after the Bronze write commits. A crash in
    between re-lands those files on the next run, which the Silver dedup
    absorbs. ``overwrite``: Bronze is replaced by exactly ``paths`` (the
    ledger is not consulted) and the ledger is rewritten to match.
    """
    if not paths:
        raise ValueError("land requires at least one path")
    check_mode(mode)
    if mode == "append" and ledger_path and table_exists(spark, ledger_path):
        todo = [r.file_path for r in pending_files(spark, paths, ledger_path).collect()]
    else:  # overwrite, or nothing landed yet: no job needed to diff the listing
        todo = list(dict.fromkeys(str(p) for p in paths))
    if not todo:
        return LandResult(0, ())
    df = with_ingest_columns(read_events(spark, todo), ingested_at)
    obs = Observation("bronze_land")
    write_table(df, bronze_path, mode=mode, partition_by=("event_date",), dynamic_overwrite=False, count_into=obs)
    rows = int(obs.get.get("rows", 0))
    if ledger_path:
        stamp = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
        (
            file_listing(spark, todo)
            .withColumn("landed_at", stamp)
            .coalesce(1)
            .write.mode(mode)
            .parquet(ledger_path)
        )
    return LandResult(rows, tuple(todo))


# ---------------------------------------------------------------------------
# hour grid and coverage
# ---------------------------------------------------------------------------


def hour_file_name(day: dt.date, hour: int) -> str:
    """Name of the dump of one hour of a day; the hour has no leading zero."""
    start = dt.datetime.combine(day, dt.time(hour))  # rejects hours that no day has
    return f"{start.date().isoformat()}-{start.hour}.json.gz"


def dump_day(path: str) -> dt.date:
    """The day that the name of a dump file says."""
    return dt.date.fromisoformat(path.rstrip("/").rsplit("/", 1)[-1][:10])


def file_name_col(date_col: Column, hour_col: Column) -> Column:
    return F.concat(F.date_format(date_col, "yyyy-MM-dd"), F.lit("-"), hour_col.cast(StringType()), F.lit(".json.gz"))


def hour_grid(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every hour of the days ``start..end`` (inclusive), one row each.

    Built with ``spark.range`` so a long range is split across tasks.
    """
    if end < start:
        raise ValueError("end must not be before start")
    n_hours = ((end - start).days + 1) * 24
    origin = dt.datetime(start.year, start.month, start.day, tzinfo=dt.timezone.utc)
    epoch = int(origin.timestamp())
    hour_start = F.timestamp_seconds(F.lit(epoch) + F.col("id") * F.lit(3600))
    return (
        spark.range(n_hours)
        .select(hour_start.alias("hour_start"))
        .withColumns({"event_date": F.to_date("hour_start"), "hour": F.hour("hour_start")})
        .withColumn("file_name", file_name_col(F.col("event_date"), F.col("hour")))
    )


def observed_hour_grid(events: DataFrame, date_col: str = "event_date") -> DataFrame:
    """Every hour of the days from the first to the last ``date_col`` in
    ``events``; the bounds come from one global min/max aggregate and the hours
    are generated by Spark (no driver round trip)."""
    bounds = events.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    start = F.to_timestamp(F.col("lo"))
    end = F.to_timestamp(F.date_add(F.col("hi"), 1)) - F.expr("INTERVAL 1 HOUR")
    return (
        bounds.where(F.col("lo").isNotNull())
        .select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("hour_start"))
        .withColumns({"event_date": F.to_date("hour_start"), "hour": F.hour("hour_start")})
        .withColumn("file_name", file_name_col(F.col("event_date"), F.col("hour")))
    )


def month_grid(spark: SparkSession, year: int, month: int) -> DataFrame:
    first = dt.date(year, month, 1)
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    return hour_grid(spark, first, nxt - dt.timedelta(days=1))


def hourly_counts(events: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """Events per hour (partial aggregation, so a hot hour stays cheap)."""
    return events.groupBy(F.date_trunc("hour", F.col(ts_col)).alias("hour_start")).agg(
        F.count(F.lit(1)).alias("n_events")
    )


def hour_coverage(grid: DataFrame, events: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """One row per grid hour with its event count; ``missing`` where none arrived."""
    counts = hourly_counts(events, ts_col)
    return (
        grid.join(counts, "hour_start", "left")
        .withColumn("n_events", F.coalesce(F.col("n_events"), F.lit(0)).cast("bigint"))
        .withColumn("missing", F.col("n_events") == 0)
        .select("hour_start", "event_date", "hour", "file_name", "n_events", "missing")
    )


def missing_runs(coverage: DataFrame) -> DataFrame:
    """``first_hour, last_hour, n_hours, n_days``: runs of consecutive missing hours of :func:`hour_coverage`.

    Runs are found within each day; only those that touch a day's first or last
    hour, two a day at most, are then joined across days by one ordered pass.
    """
    step = F.expr("INTERVAL 1 HOUR")
    in_day = Window.partitionBy("event_date").orderBy("hour_start")
    numbered = coverage.where("missing").select("event_date", "hour_start", (F.col("hour_start") - F.row_number().over(in_day) * step).alias("run"))
    runs = numbered.groupBy("event_date", "run").agg(F.min("hour_start").alias("first_hour"), F.max("hour_start").alias("last_hour"), F.count(F.lit(1)).alias("n_hours"), F.lit(1).cast("bigint").alias("n_days"))
    runs = runs.select("first_hour", "last_hour", "n_hours", "n_days")
    at_edge = (F.hour("first_hour") == 0) | (F.hour("last_hour") == 23)
    along = Window.orderBy("first_hour")
    begins = F.coalesce(F.lag("last_hour").over(along) + step != F.col("first_hour"), F.lit(True))
    edges = runs.where(at_edge).withColumn("begins", begins.cast("int")).withColumn("island", F.sum("begins").over(along))
    joined = edges.groupBy("island").agg(F.min("first_hour").alias("first_hour"), F.max("last_hour").alias("last_hour"), F.sum("n_hours").alias("n_hours"), F.sum("n_days").alias("n_days"))
    return runs.where(~at_edge).unionByName(joined.drop("island"))


def missing_files(grid: DataFrame, ledger: DataFrame) -> DataFrame:
    """Grid hours whose dump file is not in the ledger."""
    return grid.join(ledger.select("file_name"), "file_name", "left_anti")


# ---------------------------------------------------------------------------
# day / month / range landing
# ---------------------------------------------------------------------------


def list_raw_files(spark: SparkSession, raw_root: str, pattern: str = "*.json.gz") -> list[str]:
    """Dump files directly under ``raw_root`` (one listing through Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.Path(raw_root.rstrip("/") + "/" + pattern)
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(glob) or []
    return sorted(str(st.getPath().toString()) for st in found)


def files_for_range(spark: SparkSession, raw_root: str, start: dt.date, end: dt.date) -> tuple[list[str], int]:
    """Dump files under ``raw_root`` that belong to hours of ``start..end``,
    and the number of grid hours that have no file."""
    grid = hour_grid(spark, start, end)
    present = list_raw_files(spark, raw_root)
    if not present:
        return [], grid.count()
    listing = file_listing(spark, present)
    wanted = [r.file_path for r in listing.join(grid.select("file_name"), "file_name", "left_semi").collect()]
    return sorted(wanted), missing_files(grid, listing).count()


def land_range(
    spark: SparkSession,
    raw_root: str,
    start: dt.date,
    end: dt.date,
    bronze_path: str,
    ledger_path: str | None = None,
    ingested_at: dt.datetime | None = None,
) -> LandResult:
    """Land the dumps of every hour of ``start..end`` found under ``raw_root``
    (already-landed files skipped when a ledger is given)."""
    files, _ = files_for_range(spark, raw_root, start, end)
    if not files:
        return LandResult(0, ())
    return land(spark, files, bronze_path, ledger_path, ingested_at=ingested_at)


def land_day(spark: SparkSession, raw_root: str, day: dt.date, bronze_path: str, ledger_path: str | None = None) -> LandResult:
    """Land the (up to) 24 hourly dumps of one day."""
    return land_range(spark, raw_root, day, day, bronze_path, ledger_path)


def land_month(
    spark: SparkSession, raw_root: str, year: int, month: int, bronze_path: str, ledger_path: str | None = None
) -> LandResult:
    """Land every hourly dump of a calendar month."""
    first = dt.date(year, month, 1)
    last = dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)
    return land_range(spark, raw_root, first, last, bronze_path, ledger_path)


# ---------------------------------------------------------------------------
# landing in batches that can be resumed
# ---------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return hadoop, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage_batch(spark: SparkSession, files: Sequence[str], staging: str, ingested_at: dt.datetime | None = None) -> None:
    """Write the rows of some dumps to a folder of their own, beside the list of these dumps.

    Nothing outside the folder changes, so a failed call is simply repeated.
    """
    file_listing(spark, files).coalesce(1).write.mode("overwrite").parquet(f"{staging}/files")
    rows = with_ingest_columns(read_events(spark, list(files)), ingested_at)
    rows.write.mode("overwrite").partitionBy("event_date").parquet(f"{staging}/rows")


def is_staged(spark: SparkSession, staging: str) -> bool:
    """Whether the rows of a batch are there in full."""
    return table_exists(spark, f"{staging}/rows/_SUCCESS")


def publish_batch(spark: SparkSession, staging: str, bronze_path: str, ledger_path: str) -> tuple[int, tuple[str, ...]]:
    """Move a staged batch into Bronze, enter its dumps into the ledger, drop the folder; rows and dumps landed.

    Files are moved one by one under names that hold the batch, and a dump is
    entered only if it is not yet: whatever of this an earlier call has done stays
    done, so the call can be repeated until it succeeds and lands nothing twice.
    """
    batch = staging.rstrip("/").rsplit("/", 1)[-1]
    hadoop, source, fs = _fs(spark, f"{staging}/rows")
    counted = f"{staging}/count"
    if not table_exists(spark, f"{counted}/_SUCCESS"):  # before the first move
        spark.read.schema(BRONZE_SCHEMA).parquet(f"{staging}/rows").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(counted)
    for folder in fs.listStatus(source):
        if not folder.isDirectory():
            continue
        day = folder.getPath().getName()
        fs.mkdirs(hadoop.Path(f"{bronze_path}/{day}"))
        for f in fs.listStatus(folder.getPath()):
            target = hadoop.Path(f"{bronze_path}/{day}/{batch}-{f.getPath().getName()}")
            if not fs.rename(f.getPath(), target):
                raise OSError(f"can't move {f.getPath()} to {target}")
    files = [r.file_path for r in spark.read.schema("file_path string, file_name string").parquet(f"{staging}/files").collect()]
    pending_files(spark, files, ledger_path).withColumn("landed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(ledger_path)
    rows = spark.read.schema("n bigint").parquet(counted).first().n
    fs.delete(hadoop.Path(staging), True)
    return rows, tuple(files)


def staged_batches(spark: SparkSession, staging_root: str) -> list[str]:
    """Batch folders that an earlier run has left."""
    _, source, fs = _fs(spark, staging_root)
    return sorted(str(f.getPath().toString()) for f in fs.listStatus(source)) if fs.exists(source) else []
