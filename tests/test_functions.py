"""Shared column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType

from eventlake.functions import columns as C


def test_parse_timestamp_text_and_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-01-01T23:30:00Z",), ("2024-01-02T00:00:07.179575Z",), ("not-a-time",), (None,)], "s string"
    )
    got = [r.t for r in df.select(C.parse_timestamp(F.col("s"), StringType()).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 23, 30), dt.datetime(2024, 1, 2, 0, 0, 7, 179575), None, None]
    ntz = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "t timestamp_ntz")
    out = ntz.select(C.parse_timestamp(F.col("t"), TimestampNTZType()).alias("t")).first().t
    assert out == dt.datetime(2024, 1, 1, 5)


def test_safe_cast_yields_null(spark):
    df = spark.createDataFrame([("42",), ("x7",)], "s string")
    assert [r.v for r in df.select(C.safe_cast("s", "bigint").alias("v")).collect()] == [42, None]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),), (dt.date(2024, 12, 30),)], "d date")
    rows = df.select("d", *C.calendar_columns("d")).orderBy("d").collect()
    sat, mon, dec30 = rows
    assert (sat.day_of_week, sat.is_weekend) == (7, True)  # Saturday
    assert (mon.day_of_week, mon.is_weekend) == (2, False)
    assert (dec30.week_of_year, dec30.quarter) == (1, 4)  # ISO week 1 of 2025


def test_count_of_type_and_weighted(spark):
    df = spark.createDataFrame([("PushEvent", 3), ("ForkEvent", 1), ("PushEvent", 2)], "event_type string, n long")
    row = df.agg(
        C.count_of_type("PushEvent").alias("c"), C.count_of_type("PushEvent", weight=F.col("n")).alias("w")
    ).first()
    assert (row.c, row.w) == (2, 5)


def test_hash_bucket_range_and_stability(spark):
    df = spark.range(1000).withColumn("b", C.hash_bucket(["id"], seed=42))
    stats = df.agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.countDistinct("b").alias("n")).first()
    assert stats.lo >= 0 and stats.hi <= 99 and stats.n > 90
    again = df.repartition(7).withColumn("b2", C.hash_bucket(["id"], seed=42))
    assert again.where("b <> b2").count() == 0


def test_fixed_event_types():
    assert C.KNOWN_EVENT_TYPES[:5] == tuple(C.EVENT_TYPE_COLUMNS.values())
    assert len(set(C.KNOWN_EVENT_TYPES)) == 15
