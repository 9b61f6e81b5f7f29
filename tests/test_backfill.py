"""Backfill in batches: failures between any two writes, new dumps, batch borders."""

from __future__ import annotations

import datetime as dt

import pytest

from eventlake.plans import medallion
from eventlake.plans.medallion import STEPS, LakePaths, backfill, gold_tables, read_silver
from eventlake.sources import bronze
from fixtures import write_days, write_hour

START, END = dt.date(2024, 1, 1), dt.date(2024, 1, 4)


@pytest.fixture
def raw(tmp_path):
    write_days(tmp_path / "raw", START, days=4, hours=2, per_hour=3)
    return str(tmp_path / "raw")


def tables(spark, paths):
    gold = gold_tables(spark, paths)
    shown = {"bronze": bronze.read_bronze(spark, paths.bronze).drop("_ingested_at", "further"), "silver": read_silver(spark, paths).drop("_ingested_at", "_silver_processed_at")}
    shown |= {k: gold[k] for k in ("fact_events", "dim_repo", "dim_actor", "dim_date")}
    return {k: sorted(map(repr, t.collect())) for k, t in shown.items()}


def ledger(spark, paths):
    return sorted(r.file_name for r in spark.read.parquet(paths.ledger).collect())


@pytest.mark.parametrize("step", STEPS)
def test_resumed_after_each_step(spark, raw, tmp_path, step):
    whole, paths = LakePaths(str(tmp_path / "whole")), LakePaths(str(tmp_path / "lake"))
    backfill(spark, whole, raw, START, END)

    def fail(at, first, last):
        if at == step and last == END:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        backfill(spark, paths, raw, START, END, batch_days=2, after=fail)
    out = backfill(spark, paths, raw, START, END, batch_days=2)
    assert tables(spark, paths) == tables(spark, whole)
    assert ledger(spark, paths) == ledger(spark, whole) and len(ledger(spark, paths)) == 8
    assert bronze.staged_batches(spark, paths.staging) == []
    # only what was open is done again
    assert all(last == END for _, last in out["batches"]) and (out["batches"] == []) == (step == "gold")


def test_resumed_within_the_landing(spark, raw, tmp_path, monkeypatch):
    """Fails while staging, after some files are moved, and before the ledger is written."""
    whole, paths = LakePaths(str(tmp_path / "whole")), LakePaths(str(tmp_path / "lake"))
    backfill(spark, whole, raw, START, END)
    with monkeypatch.context() as m:
        m.setattr(bronze, "with_ingest_columns", lambda *a: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            backfill(spark, paths, raw, START, END)
    assert len(bronze.staged_batches(spark, paths.staging)) == 1
    real = bronze._fs

    class OneMove:
        """A file system that fails at its second move."""

        def __init__(self, fs):
            self.fs, self.moves = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.moves += 1
            if self.moves > 1:
                raise InterruptedError
            return self.fs.rename(a, b)

    def broken(spark, path):
        hadoop, target, fs = real(spark, path)
        return hadoop, target, OneMove(fs)

    with monkeypatch.context() as m:
        m.setattr(bronze, "_fs", broken)
        with pytest.raises(InterruptedError):
            backfill(spark, paths, raw, START, END)
    with monkeypatch.context() as m:
        m.setattr(bronze, "pending_files", lambda s, files, path: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            backfill(spark, paths, raw, START, END)
    out = backfill(spark, paths, raw, START, END)
    assert out["bronze_rows"] == 24 and out["files_landed"] == 8
    assert tables(spark, paths) == tables(spark, whole)


def test_new_dumps_reopen_their_batch(spark, raw, tmp_path):
    paths = LakePaths(str(tmp_path / "lake"))
    first = backfill(spark, paths, raw, START, END, batch_days=2)
    assert first["bronze_rows"] == 24 and len(first["batches"]) >= 2
    assert backfill(spark, paths, raw, START, END, batch_days=2)["batches"] == []
    write_hour(tmp_path / "raw", END, 9, 5)
    out = backfill(spark, paths, raw, START, END, batch_days=2)
    assert out["files_landed"] == 1 and len(out["batches"]) == 1 and out["batches"][0][1] == END
    assert read_silver(spark, paths).count() == 29


def test_batches_hang_on_the_calendar():
    a = medallion._batches(dt.date(2024, 1, 1), dt.date(2024, 1, 20), 7)
    b = medallion._batches(dt.date(2024, 1, 5), dt.date(2024, 1, 20), 7)
    assert a[-2:] == b[-2:] and a[0][0] == dt.date(2024, 1, 1) and b[0][0] == dt.date(2024, 1, 5)
    assert sum((y - x).days + 1 for x, y in a) == 20
    for bad in ((END, START, None), (START, END, 0)):
        with pytest.raises(ValueError):
            medallion._batches(*bad)
