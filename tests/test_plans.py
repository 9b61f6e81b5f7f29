"""Physical-plan properties the scale design relies on."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from eventlake.operators import churn, marts, validation
from eventlake.sources import driver
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stg(spark):
    return marts.stg_events(driver.events_as_silver(driver.load_events(spark, SF_SMALL)))


@pytest.mark.parametrize("build,key,name", [(marts.dim_repo, "repo_id", "repo_name"), (marts.dim_actor, "actor_id", "actor_login")])
def test_dims_hash_aggregate_events(stg, build, key, name):
    plan = _plan(build(stg))
    # the Expand-based event aggregate is hash based ...
    assert "Expand" in plan
    assert not re.search(r"SortAggregate\(key=\[[^\]]*gid", plan)
    # ... and the string maximum only sorts pre-aggregated (key, name) pairs
    assert re.search(rf"HashAggregate\(keys=\[{key}#\d+L, {name}#\d+\], functions=\[partial_count", plan)
    for line in plan.splitlines():
        if "SortAggregate" in line and "partial_max" in line:
            assert name in line


def test_fact_is_narrow(stg):
    assert "Exchange" not in _plan(marts.fact_events(stg))


@pytest.mark.parametrize("hint", [None, "merge"])
def test_orphans_aggregate_below_the_anti_join(spark, stg, hint):
    parent = marts.dim_repo(stg)
    if hint:  # force the non-broadcast path a large parent would take
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(validation.orphan_summary(marts.fact_events(stg), parent, "repo_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "LeftAnti" in line)
    below = "\n".join(lines[join_at:])
    # the child is reduced to one row per key (final count) before it meets the parent
    assert re.search(r"HashAggregate\(keys=\[repo_id#\d+L\], functions=\[count\(1\)\]", below)


def test_churn_features_one_pass_no_join(stg):
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 20), entity="actor_id", distinct_col="repo_id")
    plan = _plan(churn.build_features(marts.fact_events(stg), cfg))
    assert "Join" not in plan


def test_top_repos_is_take_ordered(stg):
    assert "TakeOrderedAndProject" in _plan(marts.top_repos(marts.dim_repo(stg)))


def test_dedup_by_exception_has_no_hint(spark):
    from eventlake.operators import silver

    rows = silver.normalize(driver.events_as_raw(driver.load_events(spark, SF_SMALL)))
    out = silver.deduplicate_by_exception(rows, silver.duplicate_ids(rows))
    logical = out._jdf.queryExecution().logical().toString()
    assert "Join LeftOuter" in logical and "ResolvedHint" not in logical
    assert out.count() == rows.count()


def test_sql_orphan_checks_count_before_the_join(spark):
    from eventlake.plans import sql_models

    sql_models.create_views(spark, silver_rows(spark))
    plan = _plan(sql_models.validate(spark, "orphans_repo"))
    assert plan.index("LeftAnti") < plan.index("partial_count")


def silver_rows(spark):
    return driver.events_as_silver(driver.load_events(spark, SF_SMALL))


