"""Quality suites kept up to date day by day.

A suite over a whole layer reads all of it on every run. Its verdicts can be
merged from small states instead:

* ``counts``: evaluated and unexpected rows per day and expectation;
* for each unique column ``keys``: the keys of a day with their number of rows,
  sorted, partitioned by day; and ``repeated``: the copies of every key that has
  more than one row, on any days.

A run of some days reads these days of the layer, replaces their counts and keys
and looks their keys (old and new) up in the key range of the other days: only
those can have become, or no longer be, repeated. Rows without a day are a day of
their own, read on every run. Merged results equal a scan of the whole layer; a
run that fails half way leaves a marker, and the next one reads all days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import quality
from eventlake.operators.silver import parse_days, select_days
from eventlake.session import scratch_dir
from eventlake.sources.tables import HIVE_NULL, drop_path, read_table, replace_days, table_exists, touch, write_table

COUNTS = "expectation string, evaluated bigint, unexpected bigint, event_date date"


def _row_level(suite: Sequence[quality.Expectation]) -> list[quality.Expectation]:
    odd = [e.label for e in suite if e.kind not in ("not_null", "in_set", "between", "unique")]
    if odd:
        raise ValueError(f"only row checks and uniqueness can be merged by day, not {odd}")
    return [e for e in suite if e.kind != "unique"]


def day_counts(rows: DataFrame, suite: Sequence[quality.Expectation]) -> DataFrame:
    """(expectation, evaluated, unexpected, event_date) of the row checks; of uniqueness the evaluated rows."""
    parts = [(e, *quality.row_level(e)) for e in _row_level(suite)]
    parts += [(e, F.count(e.column), F.lit(0)) for e in suite if e.kind == "unique"]
    made = [F.struct(F.lit(e.label).alias("expectation"), ev.cast("bigint").alias("evaluated"), un.cast("bigint").alias("unexpected")) for e, ev, un in parts]
    by_day = rows.groupBy("event_date").agg(F.array(*made).alias("r"))
    return by_day.select(F.explode("r").alias("r"), "event_date").select("r.*", "event_date")


def day_keys(rows: DataFrame, column: str) -> DataFrame:
    """(key, n, event_date): the rows of each non-NULL key on each day."""
    return rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"), "event_date").agg(F.count(F.lit(1)).alias("n"))


def repeated_rows(touched: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, n, event_date) of the touched keys that have more than one row in ``keys``."""
    low, high = touched.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return keys.where(F.lit(False))
    of = keys.where(F.col("key").between(low, high)).join(touched, "key", "left_semi")
    more = of.groupBy("key").agg(F.sum("n").alias("rows")).where("rows > 1").select("key")
    return of.join(more, "key", "left_semi").select("key", "n", "event_date")


def _in_days(days: list[dt.date]) -> Column:
    return F.coalesce(F.col("event_date").isin(days), F.lit(True))


def update(spark: SparkSession, rows: DataFrame, suite: Sequence[quality.Expectation], root: str, days: Sequence[str | dt.date] | None = None) -> None:
    """Bring the state under ``root`` up to date for ``days`` of a layer (None: all).

    ``rows``: the whole layer with ``event_date``; only the days are read.
    """
    marker = f"{root}/_changing"
    if days is not None and (table_exists(spark, marker) or not table_exists(spark, f"{root}/counts")):
        days = None
    some = select_days(rows, days, undated=True)
    wanted = None if days is None else [*[d.isoformat() for d in parse_days(days)], HIVE_NULL]
    touch(spark, marker)
    replace_days(spark, day_counts(some, suite), f"{root}/counts", wanted)
    for e in suite:
        if e.kind == "unique":
            _update_keys(spark, some, e.column, f"{root}/keys_{e.column}", f"{root}/repeated_{e.column}", days, wanted)
    drop_path(spark, marker)


def _update_keys(spark: SparkSession, some: DataFrame, column: str, keys_at: str, repeated_at: str, days, wanted) -> None:
    new_at, out_at = scratch_dir(spark, "quality-keys"), scratch_dir(spark, "quality-repeated")
    fresh = day_keys(some, column)
    kind = fresh.schema
    fresh.write.parquet(new_at)
    new = read_table(spark, new_at, kind)
    if days is None:
        repeated_rows(new.select("key").distinct(), new).write.parquet(out_at)
    else:
        keys, inside = read_table(spark, keys_at, kind), _in_days(parse_days(days))
        touched = keys.where(inside).select("key").unionAll(new.select("key")).distinct()
        now = repeated_rows(touched, keys.where(~inside).unionByName(new))
        before = read_table(spark, repeated_at, kind).join(touched, "key", "left_anti")
        before.unionByName(now).write.parquet(out_at)
    ordered = new.repartitionByRange("event_date", "key").sortWithinPartitions("event_date", "key")
    replace_days(spark, ordered, keys_at, wanted)
    write_table(read_table(spark, out_at, kind), repeated_at)
    for path in (new_at, out_at):
        drop_path(spark, path)


def merged(spark: SparkSession, layer: str, suite: Sequence[quality.Expectation], root: str, key_types: dict[str, str]) -> DataFrame:
    """The suite's results, as :func:`eventlake.operators.quality.evaluate` gives them, from the state.

    ``key_types``: the type of each unique column.
    """
    counts = spark.read.schema(COUNTS).parquet(f"{root}/counts").groupBy("expectation").agg(F.sum("evaluated").alias("evaluated"), F.sum("unexpected").alias("unexpected"))
    listed = spark.createDataFrame([(i, layer, e.label, e.column, float(e.mostly)) for i, e in enumerate(suite)], "place int, layer string, expectation string, column string, mostly double")
    out = listed.join(counts, "expectation", "left")
    for e in suite:
        if e.kind == "unique":
            rows = spark.read.schema(f"key {key_types[e.column]}, n bigint, event_date date").parquet(f"{root}/repeated_{e.column}")
            more = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("more")).select(F.lit(e.label).alias("expectation"), "more")
            out = out.join(more, "expectation", "left").withColumn("unexpected", F.coalesce("more", "unexpected")).drop("more")
    filled = out.select("layer", "expectation", "column", "mostly", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("evaluated", "unexpected")])
    return quality.judged(filled)
