"""Gold star schema: staging view, event fact, repo / actor / date dimensions.

Each mart is one declarative aggregate; Catalyst plans the partial + final
HashAggregate pair (map-side combine), so a repository or actor holding a
large share of all events is reduced per task before the shuffle.

``activity`` is an optional shared pre-aggregate at the grain
(repo, actor, day, type). Built once, it feeds both dimensions, the date
dimension and the churn features, so the event fact is scanned once instead
of four times. It has fewer rows than the events only where actors repeat
themselves within a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import EVENT_TYPE_COLUMNS, calendar_columns, count_of_type
from eventlake.schema import DIM_ACTOR_SCHEMA, DIM_REPO_SCHEMA, FACT_COLUMNS, STG_COLUMNS

ACTIVITY_KEYS = ("repo_id", "actor_id", "event_date", "event_type")


def stg_events(silver: DataFrame) -> DataFrame:
    """Staging view: Silver without the audit columns."""
    return silver.select(*STG_COLUMNS)


def fact_events(stg: DataFrame) -> DataFrame:
    """Event-grain fact (8 columns); written partitioned by ``event_date``."""
    return stg.select(*FACT_COLUMNS)


def activity(stg: DataFrame) -> DataFrame:
    """Events rolled up to (repo_id, actor_id, event_date, event_type).

    Keeps what the marts need: event count and first/last time. The display
    names ride along as grouping keys (they follow the ids, so this adds rows
    only for renames) which keeps every aggregate buffer fixed-width: the
    rollup runs as a codegen'd HashAggregate, not a sort-based one. Both id
    columns may be NULL here; each mart drops its own NULL key.
    """
    return stg.groupBy(*ACTIVITY_KEYS, "repo_name", "actor_login").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("created_at").alias("first_seen_at"),
        F.max("created_at").alias("last_seen_at"),
    )


def max_name(src: DataFrame, key: str, name: str) -> DataFrame:
    """``max(name)`` per non-NULL ``key``.

    A string maximum forces Spark's sort-based aggregate; doing it on the
    (key, name) pairs -- a hash aggregate with map-side combine -- keeps the
    sort down to one row per key and name. The outer maximum reads the pair
    count, otherwise the optimizer drops the inner aggregate as redundant
    (``max`` ignores duplicates) and sorts every input row.
    """
    pairs = src.where(F.col(key).isNotNull()).groupBy(key, name).agg(F.count(F.lit(1)).alias("_n"))
    return pairs.groupBy(key).agg(F.max(F.when(F.col("_n") > 0, F.col(name))).alias(name))


def latest_name(src: DataFrame, key: str, name: str) -> DataFrame:
    """The name seen last per non-NULL ``key`` (ties: the larger name).

    Pairs first (hash aggregate, timestamp buffer), then ``max_by`` over the
    few pairs per key.
    """
    ts = "last_seen_at" if _is_rollup(src) else "created_at"
    pairs = src.where(F.col(key).isNotNull()).groupBy(key, name).agg(F.max(ts).alias("_seen"))
    return pairs.groupBy(key).agg(F.max_by(F.col(name), F.struct("_seen", name)).alias(name))


def _names(src: DataFrame, key: str, name: str, rule: str) -> DataFrame:
    if rule == "max":
        return max_name(src, key, name)
    if rule == "latest":
        return latest_name(src, key, name)
    raise ValueError(f"name rule must be 'max' or 'latest', got {rule!r}")


def _is_rollup(df: DataFrame) -> bool:
    return "n_events" in df.columns and "first_seen_at" in df.columns


def _event_count(df: DataFrame) -> Column:
    return F.sum("n_events").cast("bigint") if _is_rollup(df) else F.count(F.lit(1))


def _first_last(df: DataFrame) -> tuple[Column, Column]:
    if _is_rollup(df):
        return F.min("first_seen_at"), F.max("last_seen_at")
    return F.min("created_at"), F.max("created_at")


def dim_repo(src: DataFrame, name_rule: str = "max") -> DataFrame:
    """One row per non-NULL ``repo_id`` with engagement metrics.

    ``src`` is the staging view / fact or the :func:`activity` rollup.
    ``repo_name`` is the lexicographic max, as in the SQL model
    (``name_rule="latest"``: the name seen last).
    """
    first, last = _first_last(src)
    weight = F.col("n_events") if _is_rollup(src) else None
    metrics = (
        src.where(F.col("repo_id").isNotNull())
        .groupBy("repo_id")
        .agg(
            first.alias("first_seen_at"),
            last.alias("last_seen_at"),
            _event_count(src).alias("total_events"),
            F.count_distinct("actor_id").alias("unique_actors"),
            F.count_distinct("event_date").alias("active_days"),
            *[count_of_type(t, weight=weight).alias(c) for c, t in EVENT_TYPE_COLUMNS.items()],
        )
    )
    names = _names(src, "repo_id", "repo_name", name_rule)
    return metrics.join(names, "repo_id", "left").select(*DIM_REPO_SCHEMA.fieldNames())


def dim_actor(src: DataFrame, name_rule: str = "max") -> DataFrame:
    """One row per non-NULL ``actor_id`` with activity metrics (options as
    :func:`dim_repo`)."""
    first, last = _first_last(src)
    metrics = (
        src.where(F.col("actor_id").isNotNull())
        .groupBy("actor_id")
        .agg(
            first.alias("first_seen_at"),
            last.alias("last_seen_at"),
            _event_count(src).alias("total_events"),
            F.count_distinct("repo_id").alias("unique_repos"),
            F.count_distinct("event_date").alias("active_days"),
            F.count_distinct("event_type").alias("distinct_event_types"),
        )
    )
    names = _names(src, "actor_id", "actor_login", name_rule)
    return metrics.join(names, "actor_id", "left").select(*DIM_ACTOR_SCHEMA.fieldNames())


def dim_date(src: DataFrame) -> DataFrame:
    """One row per observed ``event_date`` (not a filled calendar)."""
    dates = src.where(F.col("event_date").isNotNull()).select(F.col("event_date").alias("date_key")).distinct()
    return dates.select("date_key", *calendar_columns("date_key"))


def top_repos(repos: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most active repositories (ties broken by ``repo_id``).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those reach the final merge.
    """
    return (
        repos.select("repo_id", "repo_name", "total_events", "unique_actors")
        .orderBy(F.col("total_events").desc(), F.col("repo_id").asc())
        .limit(n)
    )


__all__ = [
    "ACTIVITY_KEYS",
    "activity",
    "dim_actor",
    "dim_date",
    "dim_repo",
    "fact_events",
    "latest_name",
    "max_name",
    "stg_events",
    "top_repos",
]
