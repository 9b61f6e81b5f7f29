"""Churn features, label and model."""

from __future__ import annotations

import datetime as dt

import pytest

from eventlake.operators import churn, marts
from eventlake.plans.medallion import train_churn
from eventlake.sources import driver
from conftest import SF_SMALL


def test_default_min_events_gives_no_rows(spark, month_lake):
    fact = spark.read.parquet(month_lake.gold("fact_events"))
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 16))
    feats = churn.build_features(fact, cfg)
    assert feats.count() == 0
    with pytest.raises(RuntimeError, match="no training rows"):
        churn.train(feats, cfg, spark)


def test_min_one_gives_all_churned(spark, month_lake):
    fact = spark.read.parquet(month_lake.gold("fact_events"))
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 16), min_events_in_train=1)
    feats = churn.build_features(fact, cfg)
    assert feats.count() == 300
    assert feats.where("churned = 1").count() == 300
    row = churn.churn_rate(feats).first()
    assert (row.total, row.churned, row.churn_rate) == (300, 300, 1.0)


def test_features_equal_from_rollup(spark):
    stg = marts.stg_events(driver.events_as_silver(driver.load_events(spark, SF_SMALL)))
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 20), min_events_in_train=3, entity="actor_id", distinct_col="repo_id")
    a = churn.build_features(stg, cfg)
    b = churn.build_features(marts.activity(stg), cfg)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_split_is_stable(spark):
    stg = marts.stg_events(driver.events_as_silver(driver.load_events(spark, SF_SMALL)))
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 20), min_events_in_train=1, entity="actor_id", distinct_col="repo_id")
    feats = churn.build_features(stg, cfg)
    sides = []
    for n in (1, 5):
        tr, te = churn.split(feats.repartition(n), cfg)
        sides.append((sorted(r.actor_id for r in tr.collect()), sorted(r.actor_id for r in te.collect())))
    assert sides[0] == sides[1]
    assert len(sides[0][0]) + len(sides[0][1]) == feats.count()


def test_train_and_persist(spark, tmp_path):
    from eventlake.plans.medallion import LakePaths, build_gold
    from eventlake.operators import silver

    paths = LakePaths(str(tmp_path / "lake"))
    silver.write_silver(driver.events_as_silver(driver.load_events(spark, SF_SMALL)), paths.silver, dynamic=False)
    build_gold(spark, paths)
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 25), min_events_in_train=5, entity="actor_id", distinct_col="repo_id")
    metrics = train_churn(spark, paths, cfg).first()
    assert metrics.total == metrics.train_rows + metrics.test_rows
    assert metrics.accuracy is None or 0.0 <= metrics.accuracy <= 1.0
    model = churn.load_model(paths.model)
    assert len(model.stages) == 2
    runs = spark.read.parquet(paths.ml_runs).collect()
    assert len(runs) == 1 and runs[0].params["split_date"] == "2024-01-25"


def test_single_class_test_side_has_no_auc(spark):
    rows = [(i, i % 3, dt.date(2024, 1, 1 + i % 10), "PushEvent") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id long, repo_id long, event_date date, event_type string")
    events = events.withColumn("actor_id", events.event_id % 7)
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 20), min_events_in_train=1)
    feats = churn.build_features(events, cfg)
    assert feats.count() == 3 and feats.where("churned = 1").count() == 3
    _, metrics = churn.train(feats, cfg, spark)
    m = metrics.first()
    assert m.roc_auc is None
    assert m.total == 3


def test_random_split_option(spark):
    feats = spark.range(100).selectExpr("id AS repo_id")
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 1))
    tr, te = churn.split(feats, cfg, method="random")
    assert tr.count() + te.count() == 100
    with pytest.raises(ValueError):
        churn.split(feats, cfg, method="stratified")
