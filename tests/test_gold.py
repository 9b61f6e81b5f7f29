"""Gold marts and validation on the month fixture (30 days x 4 hours x 5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eventlake.operators import marts, validation
from eventlake.plans.medallion import gold_tables, validate_gold


def test_month_silver_and_fact(spark, month_lake):
    s = spark.read.parquet(month_lake.silver)
    assert s.count() == 600
    assert s.select("event_id").distinct().count() == 600
    assert s.select("event_date").distinct().count() == 30
    import os

    assert len([d for d in os.listdir(month_lake.silver) if d.startswith("event_date=")]) == 30
    fact = spark.read.parquet(month_lake.gold("fact_events"))
    assert fact.count() == 600
    assert len(fact.columns) == 8


def test_dims_from_month(spark, month_lake):
    g = gold_tables(spark, month_lake)
    repos, actors, dates = g["dim_repo"], g["dim_actor"], g["dim_date"]
    assert repos.count() == 600 and actors.count() == 600
    assert repos.where("total_events <> 1").count() == 0
    totals = repos.agg(*[F.sum(c).alias(c) for c in ("push_events", "pr_events", "issue_events", "watch_events", "fork_events")]).first()
    assert list(totals) == [360, 0, 0, 240, 0]  # push, pull request, issue, watch, fork
    assert dates.count() == 30
    weekend = sorted(r.date_key.day for r in dates.where("is_weekend").collect())
    assert weekend == [6, 7, 13, 14, 20, 21, 27, 28]
    jan1 = dates.where(F.col("date_key") == dt.date(2024, 1, 1)).first()
    assert (jan1.year, jan1.quarter, jan1.month, jan1.day, jan1.day_of_week, jan1.week_of_year) == (2024, 1, 1, 1, 2, 1)


def test_dims_from_rollup_equal_direct(spark, month_lake):
    stg = marts.stg_events(spark.read.parquet(month_lake.silver))
    act = marts.activity(stg)
    for build in (marts.dim_repo, marts.dim_actor, marts.dim_date):
        direct, rolled = build(stg), build(act)
        assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0


def test_gold_validation_passes(spark, month_lake):
    rows = {r.check: r for r in validate_gold(spark, month_lake).collect()}
    assert set(rows) == {"fact_event_id_unique", "fact_repo_fk", "fact_actor_fk", "fact_dates_covered"}
    assert all(r.passed for r in rows.values())


def test_orphans_found_against_stale_dimension(spark, month_lake):
    g = gold_tables(spark, month_lake)
    fact = g["fact_events"]
    stale = g["dim_repo"].where(F.col("first_seen_at") < F.lit("2024-01-02").cast("timestamp"))
    summary = validation.orphan_summary(fact, stale, "repo_id").first()
    assert (summary.n_orphan_rows, summary.n_orphan_keys) == (580, 580)
    assert validation.orphan_rows(fact, stale, "repo_id").count() == 580
    gaps = validation.date_gaps(fact, g["dim_date"].where("date_key < date'2024-01-29'"))
    assert sorted(r.event_date.day for r in gaps.collect()) == [29, 30]


def test_top_repos_order_and_ties(spark, month_lake):
    repos = spark.read.parquet(month_lake.gold("dim_repo"))
    top = marts.top_repos(repos, 10).collect()
    assert len(top) == 10
    # every repo has one event, so ties resolve by repo_id
    assert [r.repo_id for r in top] == sorted(r.repo_id for r in top)
    assert top[0].repo_id == repos.agg(F.min("repo_id")).first()[0]
    plan = marts.top_repos(repos, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_null_keys_excluded_from_dims(spark):
    rows = [
        (1, "PushEvent", None, None, 5, "r/5", "{}", True, dt.datetime(2024, 1, 1, 1), dt.date(2024, 1, 1), 1),
        (2, "ForkEvent", 7, "u7", None, None, "{}", True, dt.datetime(2024, 1, 1, 2), dt.date(2024, 1, 1), 2),
    ]
    schema = (
        "event_id long, event_type string, actor_id long, actor_login string, repo_id long, repo_name string, "
        "payload_json string, public boolean, created_at timestamp, event_date date, event_hour int"
    )
    stg = spark.createDataFrame(rows, schema)
    assert [r.repo_id for r in marts.dim_repo(stg).collect()] == [5]
    assert [r.actor_id for r in marts.dim_actor(stg).collect()] == [7]
    assert validation.orphan_summary(stg, marts.dim_repo(stg), "repo_id").first().n_orphan_rows == 0


def test_latest_name_rule(spark):
    rows = [
        (1, "PushEvent", 7, "zeta", 5, "r/zz", dt.datetime(2024, 1, 1, 1), dt.date(2024, 1, 1)),
        (2, "PushEvent", 7, "alpha", 5, "r/aa", dt.datetime(2024, 1, 2, 1), dt.date(2024, 1, 2)),
    ]
    schema = (
        "event_id long, event_type string, actor_id long, actor_login string, repo_id long, repo_name string, "
        "created_at timestamp, event_date date"
    )
    stg = spark.createDataFrame(rows, schema)
    assert marts.dim_repo(stg).first().repo_name == "r/zz"  # lexicographic max
    assert marts.dim_repo(stg, name_rule="latest").first().repo_name == "r/aa"  # seen last
    assert marts.dim_actor(stg, name_rule="latest").first().actor_login == "alpha"
    assert marts.dim_repo(marts.activity(stg), name_rule="latest").first().repo_name == "r/aa"


def test_sql_models_equal_dataframe_marts(spark):
    from eventlake.plans import sql_models
    from eventlake.sources import driver

    slv = driver.events_as_silver(driver.load_events(spark, "/root/testdata/sf0.001"))
    views = sql_models.create_views(spark, slv)
    stg = marts.stg_events(slv)
    pairs = {
        "fact_events": marts.fact_events(stg),
        "dim_repo": marts.dim_repo(stg),
        "dim_actor": marts.dim_actor(stg),
        "dim_date": marts.dim_date(stg),
    }
    for name, df in pairs.items():
        assert views[name].columns == df.columns, name
        assert views[name].exceptAll(df).count() == 0 and df.exceptAll(views[name]).count() == 0, name
    assert sql_models.validate(spark, "orphans_repo").first().n == 0
    assert sql_models.validate(spark, "date_coverage").first().n == 0
    u = sql_models.validate(spark, "fact_uniqueness").first()
    assert u.n_rows == u.n_unique
    assert sql_models.validate(spark, "top_repos").count() == 10
