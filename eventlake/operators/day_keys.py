"""One row per event across daily runs: the table of each day's newest copies.

A run of some days sees only their rows, but a replay can bring an event back
under another ``created_at`` day. The key table holds, for each day that has been
run, its newest copy of every event (id, load time, event time), partitioned by
day and sorted by id. A run replaces its days there, looks its ids up in the other
days and learns two things: which of its events are newer elsewhere (*losers*),
and which other days win or lose an event by this run (they are rewritten with
it). So day runs in any order, repeated or after a day has lost rows, leave what
one full build would.

Two copies on different days differ in event time, so (load time, event time)
decides between days; within a day the full order of
:func:`eventlake.operators.silver.deduplicate` does.

The lookup reads four narrow columns of the other days, limited to the id range
of the run (files are sorted by id, so Parquet skips the rest), and keeps the
few rows whose id the run has. The days to write are recorded before the key
table changes and forgotten after Silver is written: a run that fails between
the two is completed by the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType, TimestampType

from eventlake.session import scratch_dir
from eventlake.sources.tables import drop_path, partition_values, read_table, replace_days, table_exists

KEYS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("loaded_at", TimestampType()),
        StructField("created_at", TimestampType()),
        StructField("event_date", DateType()),
    ]
)
_NEWEST = ("loaded_at", "created_at")


@dataclass(frozen=True)
class DayChange:
    """What a run has to write: its days and those that it changes, and the events that others hold."""

    days: tuple[dt.date, ...]
    losers: DataFrame


def newest_per_day(rows: DataFrame) -> DataFrame:
    """(event_id, loaded_at, created_at, event_date): the newest copy of every event of a day.

    ``rows``: projected rows that have their key. A hot event is one row per task
    in the shuffle.
    """
    order = F.struct(F.coalesce("_ingested_at", "created_at").alias("loaded_at"), F.col("created_at"))
    best = rows.groupBy("event_id", "event_date").agg(F.max(order).alias("best"))
    return best.select("event_id", "best.loaded_at", "best.created_at", "event_date")


def winning_day(keys: DataFrame) -> DataFrame:
    """(event_id, day, n_days): the day that holds the newest copy, and on how many days there is one."""
    order = F.struct(*_NEWEST, "event_date")
    return keys.groupBy("event_id").agg(F.max(order)["event_date"].alias("day"), F.count(F.lit(1)).alias("n_days"))


def _of_ids(keys: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``keys`` whose event is in ``ids``; the id range is a filter that Parquet applies to row groups."""
    low, high = ids.agg(F.min("event_id"), F.max("event_id")).first()
    if low is None:
        return keys.where(F.lit(False))
    return keys.where(F.col("event_id").between(low, high)).join(ids, "event_id", "left_semi")


def losers(keys: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """(event_id, event_date) of the copies on ``days`` that are newer on another day."""
    mine = keys.where(F.col("event_date").isin(list(days)))
    rivals = _of_ids(keys, mine.select("event_id").distinct())
    best = winning_day(rivals).where("n_days > 1").select("event_id", "day")
    return mine.join(best, "event_id").where("event_date <> day").select("event_id", "event_date")


def changed_days(old: DataFrame, new: DataFrame, rest: DataFrame) -> DataFrame:
    """Distinct ``day`` of ``rest`` that win or lose an event when ``old`` keys of a run become ``new``."""
    ids = old.select("event_id").unionAll(new.select("event_id")).distinct()
    rivals = _of_ids(rest, ids)
    own = rivals.select("event_id").distinct()
    before, after = (
        winning_day(rivals.unionByName(side.join(own, "event_id", "left_semi"))).select("event_id", F.col("day").alias(name))
        for side, name in ((old, "before"), (new, "after"))
    )
    moved = before.join(after, "event_id").where("before <> after")
    return moved.select(F.explode(F.array("before", "after")).alias("day")).distinct()


def _write(spark: SparkSession, keys: DataFrame, path: str, days: Iterable[dt.date] | None) -> None:
    """Replace ``days`` (None: all) of the key table; files hold id ranges."""
    ordered = keys.repartitionByRange("event_date", "event_id").sortWithinPartitions("event_date", "event_id")
    replace_days(spark, ordered.select(*KEYS_SCHEMA.fieldNames()), path, None if days is None else [d.isoformat() for d in days])


def _pending(spark: SparkSession, path: str) -> set[dt.date]:
    if not table_exists(spark, path):
        return set()
    return {r.day for r in spark.read.schema("day date").parquet(path).collect()}  # days of one run


def begin(spark: SparkSession, rows_of, keys_path: str, pending_path: str, silver_path: str, days: Sequence[dt.date]) -> DayChange:
    """Bring the key table up to date for a run of ``days`` and tell what is to be written.

    ``rows_of(days)`` gives the projected Bronze rows of days. A lake that was
    built as a whole has no key table yet: then the days that Silver holds are
    entered first, from narrow columns of Bronze.
    """
    wanted = set(days)
    if not table_exists(spark, keys_path):
        built = [dt.date.fromisoformat(v) for v in partition_values(spark, silver_path, "event_date")]
        _write(spark, newest_per_day(rows_of(sorted(set(built) - wanted))), keys_path, None)
    keys = read_table(spark, keys_path, KEYS_SCHEMA)
    at = scratch_dir(spark, "day-keys")
    newest_per_day(rows_of(sorted(wanted))).write.parquet(at)
    new = spark.read.schema(KEYS_SCHEMA).parquet(at)
    inside = F.col("event_date").isin(list(wanted))
    # one row per day at most
    moved = {r.day for r in changed_days(keys.where(inside), new, keys.where(~inside)).collect()}
    todo = sorted(wanted | moved | _pending(spark, pending_path))
    spark.createDataFrame([(d,) for d in todo], "day date").coalesce(1).write.mode("overwrite").parquet(pending_path)
    _write(spark, new, keys_path, wanted)
    drop_path(spark, at)
    keys = read_table(spark, keys_path, KEYS_SCHEMA)
    return DayChange(tuple(todo), losers(keys, todo))


def done(spark: SparkSession, pending_path: str) -> None:
    """The days are written: nothing is pending."""
    drop_path(spark, pending_path)


def forget(spark: SparkSession, *paths: str) -> None:
    """Before a full build: its result does not come from day runs."""
    for path in paths:
        drop_path(spark, path)
