"""Dimensions brought forward by their member tables equal those built from all days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import dim_state, marts
from eventlake.plans import medallion
from eventlake.plans.medallion import LakePaths, build_gold, gold_tables
from eventlake.schema import ACTIVITY_SCHEMA, SILVER_SCHEMA
from eventlake.sources.tables import drop_partitions, read_table, table_exists

DAYS = [dt.date(2024, 1, d) for d in range(1, 9)]
TYPES = ["PushEvent", "WatchEvent", "ForkEvent", "IssuesEvent", "GollumEvent"]


def silver_rows(spark, day, n, seed):
    """Events of one day: a hot repository, NULL ids and names, renames."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = dt.datetime.combine(day, dt.time(rng.randrange(24), rng.randrange(60)))
        actor, repo = rng.choice([None, *range(12)]), rng.choice([None, 1, 1, 1, *range(9)])
        rows.append((1000 * day.day + i, rng.choice(TYPES), actor, actor and f"dev-{actor}", repo, rng.choice([None, f"r{repo}", f"r{repo}-{day.day}"]), "{}", True, at, day, at.hour, at, at))
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def put(spark, paths, day, n, seed):
    silver_rows(spark, day, n, seed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(paths.silver)


def same(spark, paths):
    """The dimensions and member tables against a build from the rollup of all days."""
    act = read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA)
    got = gold_tables(spark, paths)
    for name, want in (("dim_repo", marts.dim_repo(act)), ("dim_actor", marts.dim_actor(act)), ("dim_date", marts.dim_date(act))):
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, want.collect())), name
    for name, dim in dim_state.DIMENSIONS.items():
        keys = [*dim_state.MEMBER_KEYS, "n_days"]
        held = spark.read.schema(dim_state.MEMBERS_SCHEMA).parquet(paths.dim_state(name)).select(*keys)
        assert sorted(map(repr, held.collect())) == sorted(map(repr, dim_state.members(act, dim).select(*keys).collect())), name


def test_days_forward_reruns_and_vanished_days(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    for k in range(3):
        put(spark, paths, DAYS[k], 40, k)
    build_gold(spark, paths)
    assert not table_exists(spark, paths.dim_state("dim_repo"))
    for k in (3, 4):
        put(spark, paths, DAYS[k], 30, k)
        build_gold(spark, paths, [DAYS[k]])
        same(spark, paths)
    put(spark, paths, DAYS[1], 10, 99)  # a day again, with other rows
    put(spark, paths, DAYS[5], 5, 5)
    build_gold(spark, paths, [DAYS[1], DAYS[5]])
    same(spark, paths)
    drop_partitions(spark, paths.silver, "event_date", [DAYS[0].isoformat()])
    build_gold(spark, paths, [DAYS[0]])
    same(spark, paths)
    assert gold_tables(spark, paths)["dim_date"].where(F.col("date_key") == DAYS[0]).isEmpty()
    build_gold(spark, paths, [DAYS[0]])  # nothing before and nothing now
    same(spark, paths)


def test_a_failed_run_starts_from_the_rollup(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path / "lake"))
    for k in range(2):
        put(spark, paths, DAYS[k], 20, k)
        build_gold(spark, paths, [DAYS[k]])
    put(spark, paths, DAYS[1], 12, 50)
    real = medallion.write_table
    monkeypatch.setattr(medallion, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        build_gold(spark, paths, [DAYS[1]])
    monkeypatch.setattr(medallion, "write_table", real)
    put(spark, paths, DAYS[2], 20, 2)
    build_gold(spark, paths, [DAYS[2]])
    same(spark, paths)


def test_a_new_day_reads_no_other_day(spark, tmp_path, monkeypatch):
    """With a rollup that can't be read beyond the new day, the run still succeeds."""
    paths = LakePaths(str(tmp_path / "lake"))
    for k in range(3):
        put(spark, paths, DAYS[k], 25, k)
    build_gold(spark, paths, DAYS[:3])
    put(spark, paths, DAYS[3], 25, 3)
    kept = spark.createDataFrame(read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA).select(*ACTIVITY_SCHEMA.fieldNames()).collect(), ACTIVITY_SCHEMA)
    for day in DAYS[:3]:
        folder = tmp_path / "lake" / "gold" / "activity" / f"event_date={day.isoformat()}"
        for f in folder.glob("*.parquet"):
            f.write_bytes(b"no parquet file")
        for f in folder.glob(".*.crc"):
            f.write_bytes(b"")
    build_gold(spark, paths, [DAYS[3]])
    act = kept.unionByName(read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA).where(F.col("event_date") == DAYS[3]))
    got = gold_tables(spark, paths)
    assert sorted(map(repr, got["dim_repo"].collect())) == sorted(map(repr, marts.dim_repo(act).collect()))
    assert sorted(map(repr, got["dim_actor"].collect())) == sorted(map(repr, marts.dim_actor(act).collect()))


def test_not_incremental(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    put(spark, paths, DAYS[0], 10, 1)
    build_gold(spark, paths, [DAYS[0]], incremental=False)
    assert not table_exists(spark, paths.dim_state("dim_actor"))


def test_hot_member_is_aggregated_before_the_shuffle(spark):
    plan = dim_state.members(spark.createDataFrame([], ACTIVITY_SCHEMA), dim_state.REPO)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 3
