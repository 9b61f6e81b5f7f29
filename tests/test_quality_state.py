"""Quality results merged from day states equal a scan of the whole layer."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from eventlake.operators import quality, quality_state
from eventlake.sources.tables import read_table

DAYS = [dt.date(2024, 1, d) for d in range(1, 7)]
KIND = "event_id long, event_type string, event_hour int, event_date date"
SUITE = [quality.not_null("event_type"), quality.unique("event_id"), quality.between("event_hour", 0, 23, mostly=0.9), quality.in_set("event_type", ["a", "b"], mostly=0.5)]
COLUMNS = ["layer", "expectation", "column", "mostly", "evaluated", "unexpected", "unexpected_percent", "success"]


def rows_of(day, seed, n=30):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(120)]), rng.choice(["a", "b", "c", None]), rng.choice([1, 12, 23, 24, None]), day) for _ in range(n)]


class Layer:
    """A table by days and its state."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root, self.path, self.days = spark, str(tmp_path / "state"), str(tmp_path / "layer"), {}

    def put(self, changes):
        self.days |= changes
        for day, rows in changes.items():
            folder = f"{self.path}/event_date={day.isoformat() if day else '__HIVE_DEFAULT_PARTITION__'}"
            self.spark.createDataFrame(rows, KIND).drop("event_date").write.mode("overwrite").parquet(folder)

    def table(self):
        return self.spark.read.schema(KIND).parquet(self.path)

    def run(self, days):
        quality_state.update(self.spark, self.table(), SUITE, self.root, days)

    def check(self):
        got = quality_state.merged(self.spark, "silver", SUITE, self.root, {"event_id": "bigint"})
        want = quality.evaluate(self.table(), SUITE, "silver")
        assert got.columns == COLUMNS
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*COLUMNS).collect()))


def test_days_reruns_and_vanished_rows(spark, tmp_path):
    layer = Layer(spark, tmp_path)
    layer.put({d: rows_of(d, i) for i, d in enumerate(DAYS[:3])} | {None: rows_of(None, 77, 5)})
    layer.run(DAYS[:1])  # no state yet: all days are read
    layer.check()
    layer.put({DAYS[3]: rows_of(DAYS[3], 3), DAYS[4]: rows_of(DAYS[4], 4)})
    layer.run(DAYS[3:5])
    layer.check()
    layer.put({DAYS[1]: rows_of(DAYS[1], 55, 4), None: rows_of(None, 78, 9)})  # a day again, with less; more undated rows
    layer.run([DAYS[1]])
    layer.check()
    layer.put({DAYS[1]: []})
    layer.run([DAYS[1]])
    layer.check()
    layer.run(None)
    layer.check()


def test_a_run_reads_its_days_only(spark, tmp_path):
    layer = Layer(spark, tmp_path)
    layer.put({d: rows_of(d, i) for i, d in enumerate(DAYS[:3])})
    layer.run(None)
    layer.put({DAYS[3]: rows_of(DAYS[3], 9)})
    want = sorted(map(tuple, quality.evaluate(layer.table(), SUITE, "silver").collect()))
    for day in DAYS[:3]:
        for f in (tmp_path / "layer" / f"event_date={day.isoformat()}").glob("*.parquet"):
            f.write_bytes(b"no parquet file")
    layer.run([DAYS[3]])
    assert sorted(map(tuple, quality_state.merged(spark, "silver", SUITE, layer.root, {"event_id": "bigint"}).collect())) == want


def test_a_failed_run_is_made_good(spark, tmp_path, monkeypatch):
    layer = Layer(spark, tmp_path)
    layer.put({d: rows_of(d, i) for i, d in enumerate(DAYS[:2])})
    layer.run(None)
    layer.put({DAYS[0]: rows_of(DAYS[0], 31)})
    real = quality_state.write_table
    monkeypatch.setattr(quality_state, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        layer.run([DAYS[0]])
    monkeypatch.setattr(quality_state, "write_table", real)
    layer.put({DAYS[2]: rows_of(DAYS[2], 2)})
    layer.run([DAYS[2]])
    layer.check()


def test_relationships_are_refused(spark, tmp_path):
    layer = Layer(spark, tmp_path)
    layer.put({DAYS[0]: rows_of(DAYS[0], 1)})
    with pytest.raises(ValueError, match="relationship"):
        quality_state.update(spark, layer.table(), [quality.relationship("event_id", "p")], layer.root)


def test_lake_layers_by_day(spark, month_lake):
    from eventlake.plans.medallion import run_quality

    full = sorted(map(tuple, run_quality(spark, month_lake).collect()))
    for days in (DAYS[:2], DAYS[1:3]):
        assert sorted(map(tuple, run_quality(spark, month_lake, days=days).collect())) == full
    assert read_table(spark, month_lake.quality_state("silver") + "/repeated_event_id").isEmpty()
