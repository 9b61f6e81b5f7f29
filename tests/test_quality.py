"""Quality suites: semantics, layer runner, gate and report."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from eventlake.operators import quality
from eventlake.plans.medallion import LakePaths, run_model_tests, run_quality
from eventlake.sources.tables import write_report


def test_suites_exist():
    assert set(quality.SUITE_BUILDERS) == {"bronze", "silver", "gold"}
    assert [len(quality.SUITE_BUILDERS[k]()) for k in ("bronze", "silver", "gold")] == [4, 6, 4]
    assert len(quality.KNOWN_EVENT_TYPES) == 15


def test_expectation_semantics(spark):
    df = spark.createDataFrame(
        [(1, "PushEvent", 0), (2, "Odd", 25), (2, "PushEvent", None), (None, None, 23)],
        "k long, t string, h int",
    )
    suite = [
        quality.not_null("k"),
        quality.unique("k"),
        quality.in_set("t", ["PushEvent"], mostly=0.5),
        quality.in_set("t", ["PushEvent"]),
        quality.between("h", 0, 23),
    ]
    res = {r.expectation: r for r in quality.evaluate(df, suite, "t").collect()}
    assert (res["not_null(k)"].evaluated, res["not_null(k)"].unexpected) == (4, 1)
    # both rows of the duplicated key are unexpected; NULL keys are ignored
    assert (res["unique(k)"].evaluated, res["unique(k)"].unexpected) == (3, 2)
    assert not res["unique(k)"].success
    in_set = [r for r in quality.evaluate(df, suite, "t").collect() if r.expectation == "in_set(t)"]
    assert sorted((r.mostly, r.success) for r in in_set) == [(0.5, True), (1.0, False)]
    assert (res["between(h)"].evaluated, res["between(h)"].unexpected) == (3, 1)


def test_empty_input_passes(spark):
    empty = spark.createDataFrame([], "event_id long, event_type string, created_at timestamp, event_date date, event_hour int")
    rows = quality.evaluate(empty, quality.silver_suite(), "silver").collect()
    assert all(r.success for r in rows)


def test_row_checks_share_one_aggregate(spark):
    df = spark.range(10).selectExpr("id AS event_id", "'PushEvent' AS event_type", "current_timestamp() AS created_at",
                                    "current_date() AS event_date", "cast(id AS int) AS event_hour")
    plan = quality.evaluate(df, quality.silver_suite(), "silver")._jdf.queryExecution().executedPlan().toString()
    # five row-level checks, one global aggregate; one grouped pass for the unique check
    assert plan.count("Generate explode") == 1


def test_run_layers_skips_unknown_and_missing(spark, tmp_path):
    tables = {"bronze": str(tmp_path / "nope"), "silver": str(tmp_path / "nope2")}
    assert quality.run_layers(spark, tables, ["bronze", "silver", "platinum"]) is None
    assert quality.assert_quality(None) == []


def test_month_layers_pass_and_report(spark, month_lake, tmp_path):
    results = run_quality(spark, month_lake)
    rows = quality.assert_quality(results)
    assert {r["layer"] for r in rows} == {"bronze", "silver", "gold"}
    summary = {r.layer: r for r in quality.summarize(results).collect()}
    assert summary["silver"].successful_expectations == 6 and summary["silver"].success
    shaped = {r.name: r for r in quality.layer_results(results).collect()}
    assert shaped["bronze"].success and shaped["bronze"].statistics["successful_expectations"] == 4.0
    assert shaped["gold"].statistics["unsuccessful_expectations"] == 0.0
    report = tmp_path / "report"
    write_report(results, str(report))
    lines = [json.loads(line) for f in Path(report).glob("*.json") for line in f.read_text().splitlines()]
    assert len(lines) == 14


def test_model_tests_pass(spark, month_lake):
    rows = run_model_tests(spark, month_lake).collect()
    assert len(rows) == 22
    assert all(r.success for r in rows)


def test_gate_raises_with_failed_names(spark):
    df = spark.createDataFrame([(1,), (1,)], "event_id long")
    with pytest.raises(quality.QualityError, match="unique\\(event_id\\)"):
        quality.assert_quality(quality.evaluate(df, [quality.unique("event_id")], "gold"))


def test_relationship_needs_parent(spark):
    df = spark.createDataFrame([(1,)], "repo_id long")
    with pytest.raises(ValueError):
        quality.evaluate(df, [quality.relationship("repo_id", "dim_repo")], "fact")
    parent = spark.createDataFrame([(2,)], "repo_id long")
    r = quality.evaluate(df, [quality.relationship("repo_id", "dim_repo")], "fact", {"dim_repo": parent}).first()
    assert (r.evaluated, r.unexpected, r.success) == (1, 1, False)
    # a repeated parent value must not multiply the child counts
    child = spark.createDataFrame([(1,), (1,), (3,)], "repo_id long")
    twice = spark.createDataFrame([(1,), (1,)], "repo_id long")
    r = quality.evaluate(child, [quality.relationship("repo_id", "p")], "fact", {"p": twice}).first()
    assert (r.evaluated, r.unexpected) == (3, 1)


def test_lake_paths_layout():
    p = LakePaths("/lake")
    assert p.silver == "/lake/silver/events"
    assert p.gold("dim_repo") == "/lake/gold/dim_repo"
    assert dt.date(2024, 1, 1)


def test_unexpected_percent(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "k long")
    r = quality.evaluate(df, [quality.not_null("k")], "t").first()
    assert (r.evaluated, r.unexpected, r.unexpected_percent) == (4, 2, 50.0)
    empty = spark.createDataFrame([], "k long")
    r = quality.evaluate(empty, [quality.between("k", 0, 1)], "t").first()
    assert r.unexpected_percent is None and r.success
    assert tuple(quality.evaluate(df, [quality.unique("k")], "t").columns) == quality.RESULT_COLUMNS
