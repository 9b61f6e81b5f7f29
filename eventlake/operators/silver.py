"""Bronze -> Silver: typed projection, key filter, quarantine, dedup, write.

Silver is the contract layer: 13 typed columns, no NULL natural key, one row
per ``event_id``, partitioned by ``event_date``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from eventlake.functions.columns import parse_timestamp, safe_cast
from eventlake.schema import CORRUPT_COLUMN, SILVER_COLUMNS, SILVER_SCHEMA, check_contract
from eventlake.sources.tables import check_mode, write_table


def _audit_ts(processed_at: dt.datetime | None) -> Column:
    return F.lit(processed_at).cast("timestamp") if processed_at else F.current_timestamp()


#: Silver column -> place in the raw record, for the columns that are only cast
SOURCE_OF = {
    "event_id": "id",
    "event_type": "type",
    "actor_id": "actor.id",
    "actor_login": "actor.login",
    "repo_id": "repo.id",
    "repo_name": "repo.name",
    "public": "public",
}
KEY_COLUMNS = ("event_id", "event_type", "created_at")
#: columns whose cast can fail
CAST_COLUMNS = ("event_id", "actor_id", "repo_id", "public", "created_at")


def _payload(bronze: DataFrame) -> Column:
    """Payload as JSON text; an inferred struct is serialised."""
    if "payload" not in bronze.columns:
        return F.lit(None)
    text = isinstance(bronze.schema["payload"].dataType, StringType)
    return F.col("payload") if text else F.to_json("payload")


def _projection(bronze: DataFrame, processed_at: dt.datetime | None) -> list[Column]:
    """One expression per contract column, cast to the contract type (NULL if malformed)."""
    time = parse_timestamp(F.col("created_at"), bronze.schema["created_at"].dataType)
    derived = {
        "payload_json": _payload(bronze),
        "created_at": time,
        "event_date": F.to_date(time),
        "event_hour": F.hour(time),
        "_ingested_at": F.col("_ingested_at") if "_ingested_at" in bronze.columns else F.lit(None),
        "_silver_processed_at": _audit_ts(processed_at),
    }
    source = derived | {name: F.col(place) for name, place in SOURCE_OF.items()}
    return [safe_cast(source[f.name], f.dataType).alias(f.name) for f in SILVER_SCHEMA.fields]


def key_present() -> Column:
    """Whether a projected row has its natural key; the one condition that Silver and quarantine share."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in KEY_COLUMNS])


def project(bronze: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """Typed 13-column projection of raw rows, before the key filter."""
    return bronze.select(*_projection(bronze, processed_at))


def _lost(bronze: DataFrame) -> Column:
    """Array of (column, raw value) that the casts of a raw row make NULL."""
    typed = {f.name: c for f, c in zip(SILVER_SCHEMA.fields, _projection(bronze, None), strict=True)}
    found = []
    for name in CAST_COLUMNS:
        raw = F.col(SOURCE_OF.get(name, name)).cast("string")
        found.append(F.when(raw.isNotNull() & typed[name].isNull(), F.struct(F.lit(name).alias("column"), raw.alias("raw"))))
    return F.array_compact(F.array(*found))


def project_with_losses(bronze: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """:func:`project` with ``_lost``: what each row's casts lose."""
    return bronze.select(*_projection(bronze, processed_at), _lost(bronze).alias("_lost"))


def cast_losses(bronze: DataFrame) -> DataFrame:
    """``column, event_date, n_rows, n_values, first_raw, last_raw``: values that casts make NULL, by column and day.

    Counted per raw value first (partial aggregation), so a value that a third of
    all rows share is one row per task. Rows without a day have NULL.
    """
    key = {f.name: c for f, c in zip(SILVER_SCHEMA.fields, _projection(bronze, None), strict=True)}
    each = bronze.select(key["event_date"], F.explode(_lost(bronze)).alias("v")).select("event_date", "v.*")
    values = each.groupBy("column", "event_date", "raw").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column", "event_date").agg(
        F.sum("n").cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_values"), F.min("raw").alias("first_raw"), F.max("raw").alias("last_raw")
    )


def normalize(bronze: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """Project raw rows onto the 13 Silver columns and drop rows without a key.

    Malformed ids, booleans and timestamps become NULL (``try_cast`` /
    ``try_to_timestamp``), so a row with a non-numeric id or unparseable
    ``created_at`` is dropped rather than failing the job.
    """
    return project(bronze, processed_at).where(key_present())


def rejects(bronze: DataFrame) -> DataFrame:
    """Exactly the rows :func:`normalize` drops, with the raw id/type/time, the
    day they are filed under (NULL if undated) and the first reason:
    ``corrupt_record`` (unparseable line), ``event_id``, ``event_type`` or
    ``created_at`` (missing or malformed)."""
    corrupt = F.col(CORRUPT_COLUMN) if CORRUPT_COLUMN in bronze.columns else F.lit(None).cast("string")
    key = {f.name: c for f, c in zip(SILVER_SCHEMA.fields, _projection(bronze, None)) if f.name in (*KEY_COLUMNS, "event_date")}
    raw = {"raw_id": "id", "raw_type": "type", "raw_created_at": "created_at"}
    rows = bronze.select(*[F.col(place).cast("string").alias(name) for name, place in raw.items()], corrupt.alias(CORRUPT_COLUMN), *key.values())
    reason = F.when(F.col(CORRUPT_COLUMN).isNotNull(), "corrupt_record")
    for name in KEY_COLUMNS:
        reason = reason.when(F.col(name).isNull(), name)
    told = rows.where(~key_present()).select(*raw, CORRUPT_COLUMN, "event_date", reason.alias("reason"))
    return told if CORRUPT_COLUMN in bronze.columns else told.drop(CORRUPT_COLUMN)


def deduplicate(events: DataFrame) -> DataFrame:
    """Keep the most recently ingested row per ``event_id``.

    Order: ``coalesce(_ingested_at, created_at)`` desc, then ``created_at``
    desc, then a hash of all other columns so ties resolve the same way on
    every run. Spark plans ``row_number() = 1`` as a partial WindowGroupLimit
    before the shuffle, so even one id replayed millions of times moves at most
    one row per map task.
    """
    skip = {"event_id", "_ingested_at", "created_at", "_silver_processed_at"}
    tie_cols = [c for c in events.columns if c not in skip]
    order = [
        F.coalesce(F.col("_ingested_at"), F.col("created_at")).desc(),
        F.col("created_at").desc(),
    ]
    if tie_cols:
        order.append(F.xxhash64(*tie_cols).desc())
    newest = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    return events.select("*", newest.alias("_place")).where("_place = 1").drop("_place")


def duplicate_ids(events: DataFrame) -> DataFrame:
    """Ids that occur more than once (hash aggregate on the id only: the
    shuffle carries one small row per id and map task, not the event rows)."""
    return (
        events.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .select("event_id")
    )


def deduplicate_by_exception(events: DataFrame, dup_ids: DataFrame, rebalance_by: str | None = None) -> DataFrame:
    """:func:`deduplicate` for inputs whose duplicated ids are known and few.

    ``dup_ids`` (from :func:`duplicate_ids`) is joined without a hint: Spark
    broadcasts it if it is small and joins by shuffle otherwise. Only rows of
    duplicated ids meet in the window. Same result as :func:`deduplicate`; the
    input is scanned twice. ``rebalance_by`` rebalances only the deduplicated
    branch on that column (e.g. the partition column of the write); the
    pass-through rows keep the layout of their input files.
    """
    marked = events.join(dup_ids.select("event_id").withColumn("_dup", F.lit(True)), "event_id", "left")
    singles = marked.where(F.col("_dup").isNull()).drop("_dup")
    repeats = deduplicate(marked.where(F.col("_dup")).drop("_dup"))
    if rebalance_by:
        repeats = repeats.hint("rebalance", rebalance_by)
    return singles.unionByName(repeats)


def parse_days(days: Sequence[str | dt.date]) -> list[dt.date]:
    """ISO strings or dates -> dates (a bad string raises here, on the driver)."""
    return [d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in days]


def select_days(df: DataFrame, days: Sequence[str | dt.date] | None, undated: bool = False) -> DataFrame:
    """Keep the given ``event_date`` values, and with ``undated`` the rows that
    have none; on a partitioned table this is partition pruning (only those
    directories are listed and read)."""
    if days is None:
        return df
    chosen = F.col("event_date").isin(parse_days(days))
    return df.where(chosen | F.col("event_date").isNull() if undated else chosen)


def to_contract(df: DataFrame) -> DataFrame:
    """Check names + types against the Silver contract; return canonical order."""
    return check_contract(df, SILVER_SCHEMA, name="silver")


def write_silver(
    df: DataFrame,
    silver_path: str,
    mode: str = "overwrite",
    dynamic: bool = True,
    rebalance: bool = True,
    count_into: Observation | None = None,
) -> None:
    """Write Silver partitioned by ``event_date``.

    ``overwrite`` with ``dynamic`` replaces only the dates present in ``df``
    (dynamic partition overwrite), so rerunning a day is idempotent and never
    wipes other days; ``dynamic=False`` replaces the whole table (full
    rebuild). ``rebalance`` adds a shuffle on the date so AQE sizes the files
    of each day; a one-day batch does not need it (each task writes one file).
    """
    check_mode(mode)
    write_table(
        to_contract(df),
        silver_path,
        mode=mode,
        partition_by=("event_date",),
        rebalance=rebalance,
        dynamic_overwrite=dynamic,
        count_into=count_into,
    )


__all__ = [
    "SILVER_COLUMNS",
    "deduplicate",
    "deduplicate_by_exception",
    "duplicate_ids",
    "key_present",
    "normalize",
    "project",
    "parse_days",
    "rejects",
    "select_days",
    "to_contract",
    "write_silver",
]
