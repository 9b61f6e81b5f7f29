"""One row per event across daily runs: any order, reruns, crashes, vanished rows."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest

from eventlake.operators import day_keys
from eventlake.plans import medallion
from eventlake.plans.medallion import LakePaths, bronze_to_silver, build_gold, run_quality
from eventlake.schema import BRONZE_SCHEMA
from eventlake.sources.tables import drop_partitions, partition_values, read_table

JAN = [dt.date(2024, 1, d) for d in range(1, 6)]


def bronze_rows(spark, paths, rows):
    """(id, day, hour, loaded day): Bronze partitioned by day."""
    made = []
    for i, day, hour, loaded in rows:
        at = dt.datetime.combine(day, dt.time(hour))
        made.append((str(i), "PushEvent", (str(i), "a", "a", None), (str(i), f"r{loaded}", None), "{}", "true", at.isoformat() + "Z", None, None, day, dt.datetime.combine(JAN[0], dt.time(1)) + dt.timedelta(days=loaded)))
    spark.createDataFrame(made, BRONZE_SCHEMA).write.mode("append").partitionBy("event_date").parquet(paths.bronze)


ROWS = [
    (1, JAN[0], 3, 1), (2, JAN[0], 4, 1), (3, JAN[1], 5, 2), (4, JAN[2], 6, 3),
    (1, JAN[2], 3, 9),  # newer on a later day
    (4, JAN[0], 1, 8),  # newer on an earlier day
    (3, JAN[3], 5, 1),  # older on a later day
    (2, JAN[0], 4, 1),  # the same row again
    (5, JAN[4], 2, 5), (5, JAN[3], 2, 5),  # equal load time: the later event time
]
WANT = {1: JAN[2], 2: JAN[0], 3: JAN[1], 4: JAN[0], 5: JAN[4]}


def held(spark, paths):
    rows = medallion.read_silver(spark, paths).collect()
    assert len({r.event_id for r in rows}) == len(rows)
    return {r.event_id: r.event_date for r in rows}


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (4, 3, 2, 1, 0), (2, 0, 4, 3, 1)])
def test_any_order_equals_the_full_build(spark, tmp_path, order):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, ROWS)
    for k in order:
        bronze_to_silver(spark, paths, [JAN[k]])
    assert held(spark, paths) == WANT
    # a second run of any day changes nothing and writes that day alone
    assert bronze_to_silver(spark, paths, [JAN[2]]).days == (JAN[2],)
    assert held(spark, paths) == WANT
    full = LakePaths(str(tmp_path / "full"))
    bronze_rows(spark, full, ROWS)
    bronze_to_silver(spark, full)
    a, b = (medallion.read_silver(spark, p).drop("_silver_processed_at") for p in (paths, full))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_several_days_in_one_run_and_both_dedup_forms(spark, tmp_path):
    for form, groups in itertools.product(("window", "exception"), (([0, 1, 2], [3, 4]), ([3, 4], [0, 2], [1]))):
        paths = LakePaths(str(tmp_path / f"{form}-{len(groups)}"))
        bronze_rows(spark, paths, ROWS)
        for some in groups:
            bronze_to_silver(spark, paths, [JAN[k] for k in some], dedup=form)
        assert held(spark, paths) == WANT


def test_days_that_change_are_named_and_gold_follows(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, [r for r in ROWS if r[0] != 4])
    for k in (0, 1):
        res = bronze_to_silver(spark, paths, [JAN[k]])
        build_gold(spark, paths, res.days)
    res = bronze_to_silver(spark, paths, [JAN[2]])
    assert res.days == (JAN[0], JAN[2])  # event 1 leaves the first day
    build_gold(spark, paths, res.days)
    fact = read_table(spark, paths.gold("fact_events")).select("event_id", "event_date")
    assert {tuple(r) for r in fact.collect()} == {(2, JAN[0]), (3, JAN[1]), (1, JAN[2])}
    report = {(r.layer, r.expectation): r.success for r in run_quality(spark, paths).collect()}
    assert report["silver", "unique(event_id)"] and report["gold", "unique(event_id)"]


def test_rows_come_back_when_the_newer_copy_vanishes(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, ROWS)
    bronze_to_silver(spark, paths)
    assert not partition_values(spark, paths.silver_keys, "event_date")  # a full build needs none
    bronze_to_silver(spark, paths, [JAN[4]])
    assert partition_values(spark, paths.silver_keys, "event_date")
    drop_partitions(spark, paths.bronze, "event_date", [JAN[2].isoformat()])
    res = bronze_to_silver(spark, paths, [JAN[2]])
    assert set(res.days) == {JAN[0], JAN[2]}
    assert held(spark, paths) == WANT | {1: JAN[0]}


def test_a_failed_run_is_completed_by_the_next(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, ROWS)
    bronze_to_silver(spark, paths, [JAN[0], JAN[1]])
    real = medallion.replace_days

    def broken(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(medallion, "replace_days", broken)
    with pytest.raises(RuntimeError):
        bronze_to_silver(spark, paths, [JAN[2]])
    monkeypatch.setattr(medallion, "replace_days", real)
    # the key table knows day 3 already; the pending days are written with any later run
    res = bronze_to_silver(spark, paths, [JAN[3], JAN[4]])
    assert set(res.days) >= {JAN[0], JAN[2], JAN[3], JAN[4]}
    assert held(spark, paths) == WANT


def test_without_across_days_each_run_stands_alone(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, ROWS)
    for day in JAN:
        assert bronze_to_silver(spark, paths, [day], across_days=False).days == (day,)
    ids = [r.event_id for r in medallion.read_silver(spark, paths).collect()]
    assert len(ids) > len(set(ids))


def test_lookup_is_pruned_by_day_and_id(spark, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    bronze_rows(spark, paths, ROWS)
    bronze_to_silver(spark, paths, JAN)
    keys = read_table(spark, paths.silver_keys, day_keys.KEYS_SCHEMA)
    rest = keys.where(~keys.event_date.isin(JAN[:1]))
    plan = day_keys._of_ids(rest, keys.where(keys.event_id < 3).select("event_id"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_id,1)" in plan and "LessThanOrEqual(event_id,2)" in plan
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters", 1)[1][:200]
