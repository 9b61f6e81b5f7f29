"""Render the physical plans of the key operators into PLANS.md.

Usage: python tools/plans.py [sf_dir] > PLANS.md

Each plan is Spark's executed plan (AQE's initial plan) with long lines cut;
the note above it says what to look for.
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from eventlake.operators import churn, layout, marts, quality, silver, validation  # noqa: E402
from eventlake.plans import queries as q  # noqa: E402
from eventlake.session import local_session, scratch_dir  # noqa: E402
from eventlake.sources import driver  # noqa: E402

WIDTH = 150


def plan_text(df) -> str:
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return "\n".join(line if len(line) <= WIDTH else line[: WIDTH - 3] + "..." for line in lines)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("plans")
    events = driver.load_events(spark, sf_dir)
    slv_path = scratch_dir(spark, "plans-silver")
    silver.write_silver(driver.events_as_silver(events), slv_path, dynamic=False)
    slv = spark.read.parquet(slv_path)
    stg = marts.stg_events(slv)
    fact = marts.fact_events(stg)
    bronze_replayed = driver.events_replayed(events)
    part_path = scratch_dir(spark, "plans-part")
    layout.write_partitioned(fact, part_path)
    clu_path = scratch_dir(spark, "plans-clu")
    layout.write_clustered(fact, clu_path, ["repo_id"], 8)
    dim_path = scratch_dir(spark, "plans-dim")
    layout.write_flat(marts.dim_repo(stg).select("repo_id", "repo_name", "total_events"), dim_path)
    dim = spark.read.parquet(dim_path)
    day = F.lit("2024-01-15").cast("date")
    dup_path = scratch_dir(spark, "plans-dups")
    silver.duplicate_ids(silver.normalize(bronze_replayed)).write.parquet(dup_path)
    dup_ids = spark.read.parquet(dup_path)

    items = [
        (
            "Silver dedup (`silver.deduplicate`)",
            "`WindowGroupLimit ... Partial` sits below the `Exchange hashpartitioning(event_id)`: each map task "
            "keeps one row per id before the shuffle, so a heavily replayed id moves one row per task.",
            silver.deduplicate(silver.normalize(bronze_replayed)),
        ),
        (
            "Silver dedup by exception (`silver.deduplicate_by_exception`)",
            "The duplicated ids (written by the narrow `duplicate_ids` pass) are broadcast; the branch of unique "
            "ids has no `Exchange` at all, only the duplicated ids' rows reach the window.",
            silver.deduplicate_by_exception(silver.normalize(bronze_replayed), dup_ids),
        ),
        (
            "Repository dimension (`marts.dim_repo`)",
            "Only `HashAggregate` on the event side (partial before each `Exchange`), the distinct counts via "
            "`Expand`; the string maximum is a small `SortAggregate` over (repo_id, repo_name) pairs that a "
            "`HashAggregate` produced first, joined per key.",
            marts.dim_repo(stg),
        ),
        (
            "Actor dimension from the activity rollup",
            "The rollup is a hash aggregate keyed by (repo, actor, day, type, names) with fixed-width buffers.",
            marts.dim_actor(marts.activity(stg)),
        ),
        (
            "Date dimension",
            "Distinct dates: partial aggregate per task, tiny shuffle.",
            marts.dim_date(stg),
        ),
        (
            "Top repositories",
            "`TakeOrderedAndProject`: every task keeps its own top 10.",
            marts.top_repos(marts.dim_repo(stg)),
        ),
        (
            "Orphan check (`validation.orphan_summary`)",
            "The fact is aggregated to distinct keys (partial aggregate) before the anti-join; the join moves keys.",
            validation.orphan_summary(fact, marts.dim_repo(stg), "repo_id"),
        ),
        (
            "Quality suite (`quality.evaluate`, Silver)",
            "All row-level checks are one `HashAggregate` without keys (one `Generate explode` turns it into rows); "
            "the unique check is its own grouped pass.",
            quality.evaluate(slv, quality.silver_suite(), "silver"),
        ),
        (
            "Churn features (`churn.build_features`)",
            "Train and holdout windows in one grouped pass (conditional aggregates), no join.",
            churn.build_features(fact, q._actor_config()),
        ),
        (
            "Partition pruning",
            "`PartitionFilters: [isnotnull(event_date), (event_date = 2024-01-15)]`, `ReadSchema: struct<>`.",
            spark.read.parquet(part_path).where(F.col("event_date") == day).groupBy().count(),
        ),
        (
            "Clustered point lookup",
            "`PushedFilters: [IsNotNull(repo_id), EqualTo(repo_id,42)]` reaches the Parquet scan.",
            spark.read.parquet(clu_path).where(F.col("repo_id") == 42).groupBy().count(),
        ),
        (
            "Broadcast join after the size check",
            "`BroadcastHashJoin` with the dimension as build side; the fact is not shuffled.",
            layout.join_dim(fact, dim, "repo_id", strategy="broadcast"),
        ),
        (
            "Sort-merge join",
            "`SortMergeJoin` with both sides hash-partitioned on repo_id.",
            layout.join_dim(fact, dim, "repo_id", strategy="shuffle"),
        ),
        (
            "Salted join (hot keys only)",
            "Join keys are (repo_id, _salt); only hot repositories get salts and replicated dimension rows.",
            layout.join_dim(fact, dim, "repo_id", strategy="salted", hot_share=1 / 95),
        ),
    ]
    print("# PLANS\n")
    print(f"Physical plans of the key operators on `{sf_dir}` (generated by `tools/plans.py`).\n")
    for title, note, df in items:
        print(f"## {title}\n\n{note}\n\n```\n{plan_text(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
