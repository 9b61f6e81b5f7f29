"""Values lost by casts, runs of missing hours, fit conditions, scoring by the recorded run."""

from __future__ import annotations

import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import churn, silver
from eventlake.plans import medallion
from eventlake.plans.medallion import LakePaths, bronze_to_silver
from eventlake.schema import FEATURE_COLUMNS, FEATURES_SCHEMA
from eventlake.sources import bronze
from fixtures import event, write_hour

DAY = dt.date(2024, 1, 1)


def test_losses_are_counted_in_the_silver_run(spark, tmp_path):
    odd = [dict(event(DAY, 0, i)) for i in range(1, 6)]
    odd[0]["actor"] = {"id": "bot", "login": "x"}
    odd[1]["repo"] = {"id": "12a"}
    odd[2]["public"] = "perhaps"
    odd[3]["id"] = "x9"
    odd[4]["actor"] = {"id": None}  # absent is not lost
    file = write_hour(tmp_path / "raw", DAY, 0, 1, [json.dumps(o) for o in odd])
    paths = LakePaths(str(tmp_path / "lake"))
    bronze.land(spark, [str(file)], paths.bronze)
    res = bronze_to_silver(spark, paths)
    assert res.cast_losses == {"actor_id": 1, "repo_id": 1, "public": 1, "event_id": 1}
    assert (res.rejected_rows, res.written_rows) == (1, 5)
    table = silver.cast_losses(bronze.read_bronze(spark, paths.bronze))
    assert {(r.column, r.event_date, r.n_rows, r.first_raw) for r in table.collect()} == {("actor_id", DAY, 1, "bot"), ("repo_id", DAY, 1, "12a"), ("public", DAY, 1, "perhaps"), ("event_id", DAY, 1, "x9")}
    assert silver.cast_losses(bronze.read_bronze(spark, paths.bronze).where("false")).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_missing_runs(spark, seed):
    rng = random.Random(seed)
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(24 * 6)]
    missing = [rng.random() < (0.5, 0.97, 0.05, 1.0)[seed] for _ in hours]
    cov = spark.createDataFrame([(h, h.date(), m) for h, m in zip(hours, missing)], "hour_start timestamp, event_date date, missing boolean")
    want, run = [], []
    for h, m in [*zip(hours, missing), (None, False)]:
        if m:
            run.append(h)
        elif run:
            want.append((run[0], run[-1], len(run), len({x.date() for x in run})))
            run = []
    assert sorted(map(tuple, bronze.missing_runs(cov).collect())) == want


def features(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.randint(5, 60), rng.randint(1, 9), rng.randint(1, 5), rng.randint(1, 20)]
        ratios = [rng.random(), rng.random() / 2, 0.25]  # the last does not vary
        p = 1 / (1 + math.exp(-(2.0 - 0.2 * x[3] + ratios[0])))
        rows.append((i, *x, *ratios, int(rng.random() < p)))
    return spark.createDataFrame(rows, FEATURES_SCHEMA)


@pytest.mark.parametrize("penalty", [0.0, 0.05])
def test_fit_conditions(spark, penalty):
    config = churn.ChurnConfig(split_date=DAY, max_iter=300, reg_param=penalty)
    rows = features(spark)
    model = churn._detached(churn.pipeline(config).fit(rows), spark)
    slopes = {r.term: r.slope for r in churn.fit_conditions(model, rows, config).collect()}
    assert set(slopes) == {"intercept", *FEATURE_COLUMNS} and max(map(abs, slopes.values())) < 1e-4
    # a model of other rows does not meet them
    other = churn.fit_conditions(model, features(spark, seed=8).withColumn("churned", 1 - F.col("churned")), config)
    assert max(abs(r.slope) for r in other.collect()) > 0.05
    scored = churn.score(model, rows).withColumn("plain", churn.formula(model))
    assert scored.where("abs(score - plain) > 1e-9 or prediction <> int(score > 0.5)").isEmpty()


def test_best_run_and_scores(spark, month_lake, tmp_path):
    with pytest.raises(ValueError):
        churn.best_run(spark, _runs(spark, tmp_path, []), "speed")
    with pytest.raises(LookupError):
        churn.best_run(spark, _runs(spark, tmp_path, [(None, 0.9)]))
    assert churn.best_run(spark, _runs(spark, tmp_path, [("a", 0.7), ("b", 0.8), ("c", None), (None, 0.99)]))["model_path"] == "b"
    config = churn.ChurnConfig(split_date=dt.date(2024, 1, 20), min_events_in_train=1)
    medallion.train_churn(spark, month_lake, config)
    scored = medallion.score_churn(spark, month_lake, "accuracy")
    assert scored.count() == spark.read.parquet(month_lake.scores).count() > 0
    assert scored.where("score is null or prediction is null or run_id is null").isEmpty()


def _runs(spark, tmp_path, rows):
    path = str(tmp_path / f"runs-{len(rows)}-{random.random()}")
    made = [(m, auc, auc, dt.datetime(2024, 1, 1)) for m, auc in rows]
    spark.createDataFrame(made, "model_path string, roc_auc double, accuracy double, logged_at timestamp").write.parquet(path)
    return path
