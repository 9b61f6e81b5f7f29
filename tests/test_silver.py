"""Bronze -> Silver: projection, key filter, dedup, contract, reruns."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventlake.operators import silver
from eventlake.plans.medallion import LakePaths, bronze_to_silver
from eventlake.schema import SILVER_COLUMNS, ContractError
from eventlake.sources import bronze
from fixtures import event, write_hour


def _bronze(spark, files, ingested_at=None):
    return bronze.with_ingest_columns(bronze.read_events(spark, files), ingested_at)


def test_normalize_schema_and_first_row(spark, day_files):
    df = silver.normalize(_bronze(spark, day_files))
    assert tuple(df.columns) == SILVER_COLUMNS
    first = df.orderBy("event_id").first()
    assert (first.event_id, first.event_hour) == (7, 0)
    assert (first.actor_id, first.repo_id, first.repo_name, first.public) == (18, 21, "team/project-7", True)
    assert first.payload_json.startswith("{")
    assert first.created_at == dt.datetime(2024, 1, 1, 0, 0)
    assert df.count() == 15


def test_replayed_hour_dedups_to_latest(spark, hour_files):
    a = _bronze(spark, hour_files, dt.datetime(2024, 1, 2, 0, 0))
    b = _bronze(spark, hour_files, dt.datetime(2024, 1, 3, 0, 0))
    out = silver.deduplicate(silver.normalize(a.unionByName(b)))
    rows = out.collect()
    assert len(rows) == 10
    assert {r._ingested_at for r in rows} == {dt.datetime(2024, 1, 3, 0, 0)}


def test_dedup_ties_are_deterministic(spark, hour_files):
    same = dt.datetime(2024, 1, 2)
    a = _bronze(spark, hour_files, same)
    b = _bronze(spark, hour_files, same).withColumn("payload", F.lit('{"other": 1}'))
    u = a.unionByName(b)
    runs = [
        sorted((r.event_id, r.payload_json) for r in silver.deduplicate(silver.normalize(u.repartition(n))).collect())
        for n in (1, 3, 7)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert len(runs[0]) == 10


def test_malformed_rows_are_dropped_and_quarantined(spark, tmp_path):
    good = event(dt.date(2024, 1, 1), 0, 0)
    bad_id = dict(event(dt.date(2024, 1, 1), 0, 1), id="x7")
    bad_ts = dict(event(dt.date(2024, 1, 1), 0, 2), created_at="yesterday")
    no_type = event(dt.date(2024, 1, 1), 0, 3)
    no_type.pop("type")
    nulls = dict(event(dt.date(2024, 1, 1), 0, 4), actor=None, repo=None)
    path = tmp_path / "2024-01-01-0.json"
    path.write_text("\n".join(json.dumps(e) for e in (good, bad_id, bad_ts, no_type, nulls)) + "\n")
    raw = _bronze(spark, [str(path)])
    kept = silver.normalize(raw).orderBy("event_id").collect()
    assert [r.event_id for r in kept] == [7, 11]
    assert kept[1].actor_id is None and kept[1].repo_id is None
    reasons = sorted(r.reason for r in silver.rejects(raw).collect())
    assert reasons == ["created_at", "event_id", "event_type"]


def test_contract_rejects_missing_or_mistyped_columns(spark, day_files, tmp_path):
    df = silver.normalize(_bronze(spark, day_files))
    with pytest.raises(ContractError, match="public"):
        silver.write_silver(df.drop("public"), str(tmp_path / "s"))
    with pytest.raises(ContractError, match="event_hour"):
        silver.write_silver(df.withColumn("event_hour", F.col("event_hour").cast("string")), str(tmp_path / "s"))
    with pytest.raises(ValueError):
        silver.write_silver(df, str(tmp_path / "s"), mode="merge")


def test_select_days_rejects_bad_date():
    with pytest.raises(ValueError):
        silver.parse_days(["2024-13-01"])


def test_rerun_of_a_day_is_idempotent_and_keeps_other_days(spark, tmp_path):
    raw = tmp_path / "raw"
    files = [str(write_hour(raw, dt.date(2024, 1, d), 0, 5)) for d in (1, 2, 3)]
    paths = LakePaths(str(tmp_path / "lake"))
    bronze.land(spark, files, paths.bronze, paths.ledger)
    first = bronze_to_silver(spark, paths)
    assert (first.input_rows, first.rejected_rows, first.written_rows) == (15, 0, 15)
    again = bronze_to_silver(spark, paths, days=["2024-01-02"])
    assert again.written_rows == 5
    s = spark.read.parquet(paths.silver)
    assert s.count() == 15
    assert s.select("event_date").distinct().count() == 3
    # a full rebuild still gives the same table
    bronze_to_silver(spark, paths)
    assert spark.read.parquet(paths.silver).count() == 15


def test_replay_through_jobs(spark, hour_files, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze.land(spark, hour_files, paths.bronze)
    bronze.land(spark, hour_files, paths.bronze)
    assert bronze.read_bronze(spark, paths.bronze).count() == 20
    res = bronze_to_silver(spark, paths)
    assert res.written_rows == 10
    assert spark.read.parquet(paths.silver).select("event_id").distinct().count() == 10


def test_dedup_plan_limits_before_shuffle(spark, day_files):
    df = silver.deduplicate(silver.normalize(_bronze(spark, day_files)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedup_by_exception_equals_window_dedup(spark, tmp_path):
    from eventlake.sources import driver as drv

    rows = silver.normalize(drv.events_as_raw(drv.load_events(spark, "/root/testdata/sf0.001")))
    # a quarter of the ids arrive again later: both paths carry rows
    extra = rows.where(F.col("event_id") % 4 == 0).withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 2 DAYS"))
    rows = rows.unionByName(extra)
    p = str(tmp_path / "dups")
    silver.duplicate_ids(rows).write.parquet(p)
    dups = spark.read.parquet(p)
    assert dups.count() == 250
    a = silver.deduplicate(rows).drop("_silver_processed_at")
    b = silver.deduplicate_by_exception(rows, dups).drop("_silver_processed_at")
    assert a.count() == b.count() == 1000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # no duplicates at all: nothing is shuffled through the window
    uniq = silver.normalize(drv.events_as_raw(drv.load_events(spark, "/root/testdata/sf0.001")))
    none = spark.createDataFrame([], "event_id long")
    plan = silver.deduplicate_by_exception(uniq, none)._jdf.queryExecution().executedPlan().toString()
    assert silver.deduplicate_by_exception(uniq, none).count() == 1000
    assert "BroadcastHashJoin" in plan


def test_bronze_to_silver_dedup_forms(spark, hour_files, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze.land(spark, hour_files, paths.bronze)
    bronze.land(spark, hour_files, paths.bronze)
    for form in ("window", "exception"):
        res = bronze_to_silver(spark, paths, dedup=form)
        assert (res.input_rows, res.rejected_rows, res.written_rows) == (20, 0, 10)
        assert spark.read.parquet(paths.silver).count() == 10
    with pytest.raises(ValueError):
        bronze_to_silver(spark, paths, dedup="hash")


def test_quarantine_is_the_complement_and_reruns_alike(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    lines = [json.dumps(dict(event(day, 0, 1), id="x7")), json.dumps(dict(event(day, 0, 2), created_at="yesterday")), "{broken", json.dumps(dict(event(day, 0, 3), actor="odd shape"))]
    files = [str(write_hour(tmp_path / "raw", day, 0, 1, lines)), str(write_hour(tmp_path / "raw", dt.date(2024, 1, 2), 0, 2))]
    paths = LakePaths(str(tmp_path / "lake"))
    bronze.land(spark, files, paths.bronze)
    runs = [None, ["2024-01-01"], ["2024-01-01", "2024-01-02"], ["2024-01-02"]]
    for days in runs:
        res = bronze_to_silver(spark, paths, days)
        bad = spark.read.parquet(paths.quarantine)
        assert sorted(r.reason for r in bad.collect()) == ["corrupt_record", "created_at", "event_id"]
        assert spark.read.parquet(paths.silver).count() == 4
        assert res.rejected_rows == (3 if days is None or "2024-01-01" in days else 2)


def test_full_rebuild_replaces_even_under_session_dynamic_mode(spark, tmp_path):
    rows = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))]
    from eventlake.sources.tables import write_table

    path = str(tmp_path / "t")
    write_table(spark.createDataFrame(rows, "k long, event_date date"), path, partition_by=("event_date",))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(
            spark.createDataFrame(rows[:1], "k long, event_date date"),
            path,
            partition_by=("event_date",),
            dynamic_overwrite=False,
        )
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.k for r in spark.read.parquet(path).collect()] == [1]


def test_inferred_schema_payload_is_serialised(spark, day_files):
    raw = bronze.with_ingest_columns(bronze.read_events(spark, day_files, infer=True))
    assert raw.schema["payload"].dataType.typeName() == "struct"
    rows = silver.normalize(raw).orderBy("event_id").collect()
    assert len(rows) == 15
    assert json.loads(rows[0].payload_json) == {"size": 0, "ref": "refs/heads/b0"}
    assert rows[0].actor_id == 18 and rows[0].repo_id == 21
