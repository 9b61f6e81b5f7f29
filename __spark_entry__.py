"""

``entry(spark)`` runs the flagship query (repo dimension -> ten most active
repositories) on sf0.001. ``queries()`` maps every implemented operator to a
``(spark, sf_dir) -> DataFrame`` callable over the whole test tables, and
``oracle_sql()`` gives the DuckDB statement that must return the same rows.
Queries without an SQL form (model training) are checked on rows only.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# the package sits next to this file; make it importable however this module is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from eventlake.operators import quality  # noqa: E402
from eventlake.plans import queries as q  # noqa: E402
from eventlake.schema import FEATURE_COLUMNS  # noqa: E402
from eventlake.session import configure  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from eventlake.llm import registry
except ModuleNotFoundError as missing:
    # absent: the part itself, or a third-party module that only it needs
    own = (missing.name or "").split(".")[0] in ("corpus_pipeline", "eventlake")
    if own and missing.name not in ("corpus_pipeline", "eventlake.llm"):
        raise
    registry = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    configure(spark)
    return q.top_repos(spark, SMOKE_DIR)


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _importing(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this folder on the import path of the session's Python workers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if _HERE not in paths:
            env["PYTHONPATH"] = os.pathsep.join([_HERE, *paths])
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = [
        "silver_normalize",
        "silver_normalize_bad_rows",
        "silver_rejects",
        "silver_dedup",
        "silver_dedup_by_exception",
        "silver_incremental_days",
        "stg_events",
        "fact_events",
        "dim_repo",
        "dim_actor",
        "dim_date",
        "dim_repo_from_activity",
        "dim_actor_from_activity",
        "dim_date_from_activity",
        "top_repos",
        "fact_key_uniqueness",
        "orphans_repo",
        "orphans_actor",
        "orphans_actor_stale_dim",
        "orphan_rows_actor_stale_dim",
        "date_gaps",
        "date_gaps_stale_dim",
        "gold_checks",
        "quality_bronze",
        "quality_bronze_bad_rows",
        "quality_silver",
        "quality_silver_replayed",
        "quality_gold",
        "quality_models",
        "quality_summary",
        "quality_report",
        "churn_features",
        "churn_features_from_activity",
        "churn_features_repo",
        "churn_rate",
        "churn_split_sizes",
        "churn_split_counts",
        "churn_model_metrics",
        "pruned_partition_count",
        "flat_date_count",
        "clustered_lookup",
        "zordered_lookup",
        "optimized_lookup",
        "join_broadcast",
        "join_shuffle",
        "join_auto",
        "join_salted",
        "join_salted_hot_keys",
        "hot_repos",
        "hour_coverage",
        "daily_coverage",
        "month_coverage_gaps",
        "bronze_roundtrip",
        "silver_from_landed_dumps",
        "gold_dim_repo_built",
        "sql_fact_events",
        "sql_dim_repo",
        "sql_dim_actor",
        "sql_dim_date",
        "sql_top_repos",
        "sql_fact_uniqueness",
        "sql_orphans_repo",
        "sql_orphans_actor",
        "sql_date_coverage",
        "dim_repo_latest_name",
        "streaming_silver_dedup",
        "silver_rerun_days",
        "gold_incremental_dim_actor",
        "bronze_string_ids",
        "bronze_schema_growth",
        "payload_struct_json",
        "quarantine_incremental",
        "silver_rerun_vanished_day",
        "fact_built",
        "ledger_rerun",
        "orphans_repo_stale_dim",
        "sql_orphans_stale_views",
        "hour_coverage_gaps",
        "dim_repo_renamed",
        "churn_fixed_score",
        "run_report",
        "silver_cross_day_replays",
        "silver_cross_day_vanished",
        "gold_forward_dim_repo",
        "gold_forward_dim_actor",
        "bronze_new_members",
        "bronze_member_columns",
        "quality_merged_days",
        "backfill_resumed",
        "silver_cast_losses",
        "missing_hour_runs",
        "churn_fit_conditions",
        "churn_batch_scores",
        "bloom_lookup",
        "join_bucketed",
    ]
    out = {n: _wrap(getattr(q, n)) for n in names}
    if registry is not None:
        out |= {n: _importing(f) for n, f in (registry.QUERIES | {"pipeline": corpus_pipeline.run}).items()}
    return out


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

# The events table mapped to the Silver shape (same rules as
# eventlake.sources.driver): type map, user -> actor, props.k -> repo.
_SILVER_CTE = """
silver AS (
    SELECT
        event_id,
        CASE event_type
            WHEN 'purchase' THEN 'PushEvent'
            WHEN 'signup'   THEN 'PullRequestEvent'
            WHEN 'error'    THEN 'IssuesEvent'
            WHEN 'view'     THEN 'WatchEvent'
            WHEN 'click'    THEN 'ForkEvent'
            ELSE event_type
        END                                                   AS event_type,
        user_id                                               AS actor_id,
        'user' || CAST(user_id AS VARCHAR)                    AS actor_login,
        TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS repo_id,
        'repo' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS repo_name,
        props                                                 AS payload_json,
        true                                                  AS public,
        ts                                                    AS created_at,
        CAST(ts AS DATE)                                      AS event_date,
        CAST(hour(ts) AS INTEGER)                             AS event_hour,
        ts + INTERVAL 1 HOUR                                  AS _ingested_at
    FROM events
)"""

_STG_COLS = (
    "event_id, event_type, actor_id, actor_login, repo_id, repo_name, payload_json, "
    "public, created_at, event_date, event_hour"
)
_FACT_COLS = "event_id, event_type, repo_id, actor_id, event_date, event_hour, created_at, public"

_DIM_REPO = """
SELECT
    repo_id,
    max(repo_name)                                                               AS repo_name,
    min(created_at)                                                              AS first_seen_at,
    max(created_at)                                                              AS last_seen_at,
    count(*)                                                                     AS total_events,
    count(DISTINCT actor_id)                                                     AS unique_actors,
    count(DISTINCT event_date)                                                   AS active_days,
    count(*) FILTER (WHERE event_type = 'PushEvent')                             AS push_events,
    count(*) FILTER (WHERE event_type = 'PullRequestEvent')                      AS pr_events,
    count(*) FILTER (WHERE event_type = 'IssuesEvent')                           AS issue_events,
    count(*) FILTER (WHERE event_type = 'WatchEvent')                            AS watch_events,
    count(*) FILTER (WHERE event_type = 'ForkEvent')                             AS fork_events
FROM silver
WHERE repo_id IS NOT NULL
GROUP BY repo_id"""

_DIM_ACTOR = """
SELECT
    actor_id,
    max(actor_login)           AS actor_login,
    min(created_at)            AS first_seen_at,
    max(created_at)            AS last_seen_at,
    count(*)                   AS total_events,
    count(DISTINCT repo_id)    AS unique_repos,
    count(DISTINCT event_date) AS active_days,
    count(DISTINCT event_type) AS distinct_event_types
FROM silver
WHERE actor_id IS NOT NULL
GROUP BY actor_id"""

_DIM_DATE = """
SELECT
    date_key,
    CAST(year(date_key) AS INTEGER)           AS year,
    CAST(quarter(date_key) AS INTEGER)        AS quarter,
    CAST(month(date_key) AS INTEGER)          AS month,
    CAST(day(date_key) AS INTEGER)            AS day,
    CAST(dayofweek(date_key) + 1 AS INTEGER)  AS day_of_week,
    CAST(weekofyear(date_key) AS INTEGER)     AS week_of_year,
    (dayofweek(date_key) + 1) IN (1, 7)       AS is_weekend
FROM (SELECT DISTINCT event_date AS date_key FROM silver WHERE event_date IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bad_rows_cte() -> str:
    # low-value events carry a letter-prefixed id, high-value ones an
    # unparseable created_at; the normalisation drops both kinds.
    return _SILVER_CTE.replace("FROM events", "FROM events WHERE NOT (value < 5.0) AND NOT (value > 150.0)")


_RAW_TYPE = """CASE event_type
        WHEN 'purchase' THEN 'PushEvent' WHEN 'signup' THEN 'PullRequestEvent'
        WHEN 'error' THEN 'IssuesEvent' WHEN 'view' THEN 'WatchEvent'
        WHEN 'click' THEN 'ForkEvent' ELSE event_type END"""

# raw (Bronze-shaped) columns of the events table, flattened
_RAW_CTE = f"""
raw AS (
    SELECT
        CAST(event_id AS VARCHAR)                               AS id,
        {_RAW_TYPE}                                             AS type,
        user_id                                                 AS actor_id,
        'user' || CAST(user_id AS VARCHAR)                      AS actor_login,
        TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)   AS repo_id,
        'repo' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS repo_name,
        props                                                   AS payload,
        true                                                    AS public,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')                   AS created_at,
        CAST(ts AS DATE)                                        AS event_date,
        value
    FROM events
)"""


def _suite_sql(source: str, layer: str, suite: list, parents: dict[str, str] | None = None) -> str:
    """One SELECT per expectation over ``source`` (a relation name), unioned."""
    parts = []
    for e in suite:
        head = f"'{layer}' AS layer, '{e.label}' AS expectation, '{e.column}' AS \"column\", CAST({float(e.mostly)!r} AS DOUBLE) AS mostly"
        c = e.column
        if e.kind == "not_null":
            body = f"SELECT {head}, count(*) AS evaluated, count(*) FILTER (WHERE {c} IS NULL) AS unexpected FROM {source}"
        elif e.kind == "in_set":
            vals = ", ".join(f"'{v}'" for v in e.value_set)
            body = (
                f"SELECT {head}, count({c}) AS evaluated, "
                f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals})) AS unexpected FROM {source}"
            )
        elif e.kind == "between":
            body = (
                f"SELECT {head}, count({c}) AS evaluated, "
                f"count(*) FILTER (WHERE {c} < {e.min_value} OR {c} > {e.max_value}) AS unexpected FROM {source}"
            )
        elif e.kind == "unique":
            body = (
                f"SELECT {head}, coalesce(sum(n), 0) AS evaluated, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS unexpected "
                f"FROM (SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"
            )
        elif e.kind == "relationship":
            parent = (parents or {})[e.parent]
            body = (
                f"SELECT {head}, count(*) AS evaluated, "
                f"count(*) FILTER (WHERE {c} NOT IN (SELECT {e.parent_column} FROM {parent} "
                f"WHERE {e.parent_column} IS NOT NULL)) AS unexpected FROM {source} WHERE {c} IS NOT NULL"
            )
        else:
            raise ValueError(e.kind)
        parts.append(body)
    union = "\nUNION ALL\n".join(parts)
    return (
        "SELECT layer, expectation, \"column\", mostly, CAST(evaluated AS BIGINT) AS evaluated, "
        "CAST(unexpected AS BIGINT) AS unexpected, "
        "CASE WHEN evaluated > 0 THEN unexpected * 100.0 / evaluated END AS unexpected_percent, "
        "(evaluated = 0 OR CAST(evaluated - unexpected AS DOUBLE) >= mostly * evaluated) AS success "
        f"FROM ({union})"
    )


_DIM_REPO_CTE = "repos AS (" + _DIM_REPO + ")"
_DIM_ACTOR_CTE = "actors AS (" + _DIM_ACTOR + ")"


def _features_sql(entity: str, other: str, split: str, min_events: int) -> str:
    return f"""
train AS (
    SELECT {entity},
        count(*)                   AS n_events,
        count(DISTINCT {other})    AS n_actors,
        count(DISTINCT event_type) AS n_event_types,
        count(DISTINCT event_date) AS days_active,
        count(*) FILTER (WHERE event_type = 'PushEvent')        AS push_count,
        count(*) FILTER (WHERE event_type = 'PullRequestEvent') AS pr_count,
        count(*) FILTER (WHERE event_type = 'IssuesEvent')      AS issue_count
    FROM silver
    WHERE event_date < DATE '{split}' AND {entity} IS NOT NULL
    GROUP BY {entity}
),
holdout AS (
    SELECT {entity}, count(*) AS holdout_events
    FROM silver WHERE event_date >= DATE '{split}' GROUP BY {entity}
),
features AS (
    SELECT t.{entity}, n_events, n_actors, n_event_types, days_active,
        CAST(push_count AS DOUBLE) / n_events  AS push_ratio,
        CAST(pr_count AS DOUBLE) / n_events    AS pr_ratio,
        CAST(issue_count AS DOUBLE) / n_events AS issue_ratio,
        CAST(coalesce(h.holdout_events, 0) = 0 AS INTEGER) AS churned
    FROM train t LEFT JOIN holdout h ON t.{entity} = h.{entity}
    WHERE n_events >= {min_events}
)"""


def _quality_oracles() -> dict[str, str]:
    bad_raw = f"""
bad AS (
    SELECT
        CASE WHEN value < 5.0 THEN 'x' || id ELSE id END          AS id,
        CASE WHEN type = 'ForkEvent' THEN 'click' ELSE type END   AS type,
        CASE WHEN value > 150.0 THEN NULL ELSE created_at END     AS created_at
    FROM raw
)"""
    replayed = "replayed AS (SELECT * FROM silver UNION ALL SELECT * FROM silver)"
    models = [
        ("stg_events", "silver"),
        ("fact_events", "silver"),
        ("dim_date", "dates"),
        ("dim_repo", "repos"),
        ("dim_actor", "actors"),
    ]
    dates = "dates AS (" + _DIM_DATE + ")"
    parents = {"dim_repo": "repos", "dim_actor": "actors"}
    model_sql = "\nUNION ALL\n".join(
        _suite_sql(src, name, quality.MODEL_SUITES[name](), parents) for name, src in models
    )
    layers = "\nUNION ALL\n".join(
        [
            _suite_sql("raw", "bronze", quality.bronze_suite()),
            _suite_sql("silver", "silver", quality.silver_suite()),
            _suite_sql("silver", "gold", quality.gold_suite()),
        ]
    )
    with_bad_rows = bad_raw.replace("bad AS", "bad_rows AS").replace("CASE WHEN type = 'ForkEvent' THEN 'click' ELSE type END   AS type", "type").replace("THEN NULL", "THEN 'not-a-timestamp'")
    day_runs = """
day_runs AS (
    SELECT * FROM (
        SELECT * FROM silver UNION ALL SELECT * REPLACE (event_date + 2 AS event_date) FROM silver WHERE event_id % 13 = 0
        UNION ALL SELECT * FROM silver WHERE event_id % 17 = 0
    ) WHERE event_date <= DATE '2024-02-09' AND (event_id % 2 = 0 OR event_date <> DATE '2024-01-05')
)"""
    merged = [_suite_sql("bad_rows", "bronze", quality.bronze_suite()), _suite_sql("day_runs", "silver", quality.silver_suite())]
    return {
        "quality_merged_days": _with(_SILVER_CTE, _RAW_CTE, with_bad_rows, day_runs) + "\nUNION ALL\n".join(merged),
        "quality_bronze": _with(_RAW_CTE) + _suite_sql("raw", "bronze", quality.bronze_suite()),
        "quality_bronze_bad_rows": _with(_RAW_CTE, bad_raw) + _suite_sql("bad", "bronze", quality.bronze_suite()),
        "quality_silver": _with(_SILVER_CTE) + _suite_sql("silver", "silver", quality.silver_suite()),
        "quality_silver_replayed": _with(_SILVER_CTE, replayed)
        + _suite_sql("replayed", "silver", quality.silver_suite()),
        "quality_gold": _with(_SILVER_CTE) + _suite_sql("silver", "gold", quality.gold_suite()),
        "quality_models": _with(_SILVER_CTE, _DIM_REPO_CTE, _DIM_ACTOR_CTE, dates) + model_sql,
        "quality_report": _with(_SILVER_CTE, _RAW_CTE) + layers,
        "quality_summary": _with(_SILVER_CTE, _RAW_CTE, f"results AS ({layers})")
        + """
SELECT layer,
    count(*)                                   AS evaluated_expectations,
    count(*) FILTER (WHERE success)            AS successful_expectations,
    count(*) FILTER (WHERE NOT success)        AS unsuccessful_expectations,
    count(*) FILTER (WHERE success) * 100.0 / count(*) AS success_percent,
    bool_and(success)                          AS success
FROM results GROUP BY layer""",
    }


#: copies of an event: as it came, again three days on (newer), and two days before (older); the newest stands
_COPIES_CTE = """
copies AS (
    SELECT * FROM silver
    UNION ALL
    SELECT * REPLACE (created_at + INTERVAL 3 DAY AS created_at, CAST(created_at + INTERVAL 3 DAY AS DATE) AS event_date, created_at + INTERVAL 10 DAY AS _ingested_at)
    FROM silver WHERE event_id % 5 = 0
    UNION ALL
    SELECT * REPLACE (created_at - INTERVAL 2 DAY AS created_at, CAST(created_at - INTERVAL 2 DAY AS DATE) AS event_date, created_at - INTERVAL 1 DAY AS _ingested_at)
    FROM silver WHERE event_id % 7 = 0
)"""
_NEWEST_COPY = """SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at DESC, created_at DESC) AS place FROM copies {where}
) WHERE place = 1"""


def oracle_sql() -> dict[str, str]:
    silver_all = _with(_SILVER_CTE) + "SELECT * FROM silver"
    base = _with(_SILVER_CTE)
    orphan_summary = """
SELECT CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_orphan_rows, count(*) AS n_orphan_keys
FROM (
    SELECT {k}, count(*) AS n_rows FROM silver WHERE {k} IS NOT NULL GROUP BY {k}
) c
WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{k} = c.{k})"""
    actor_snapshot = "SELECT DISTINCT actor_id FROM silver WHERE event_date < DATE '2024-01-02' AND actor_id IS NOT NULL"
    join_rows = (
        _with(_SILVER_CTE, _DIM_REPO_CTE)
        + "SELECT s.event_id, s.repo_id, r.repo_name, r.total_events FROM silver s JOIN repos r ON s.repo_id = r.repo_id"
    )
    features_actor = _with(_SILVER_CTE, _features_sql("actor_id", "repo_id", "2024-01-30", 5))
    coverage = _with(
        _SILVER_CTE,
        "b AS (SELECT min(event_date) AS lo, max(event_date) AS hi FROM silver)",
        "grid AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 23 HOUR, "
        "INTERVAL 1 HOUR)) AS hour_start FROM b)",
        "counts AS (SELECT date_trunc('hour', created_at) AS hour_start, count(*) AS n_events FROM silver GROUP BY 1)",
        """cov AS (
    SELECT g.hour_start,
        CAST(g.hour_start AS DATE)          AS event_date,
        CAST(hour(g.hour_start) AS INTEGER) AS hour,
        strftime(g.hour_start, '%Y-%m-%d') || '-' || CAST(hour(g.hour_start) AS VARCHAR) || '.json.gz' AS file_name,
        CAST(coalesce(c.n_events, 0) AS BIGINT) AS n_events,
        coalesce(c.n_events, 0) = 0         AS missing
    FROM grid g LEFT JOIN counts c ON g.hour_start = c.hour_start
)""",
    )
    out = {
        "silver_normalize": silver_all,
        "silver_normalize_bad_rows": _with(_bad_rows_cte()) + "SELECT * FROM silver",
        "silver_rejects": """
SELECT
    CASE WHEN value < 5.0 THEN 'x' || CAST(event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS raw_id,
    CASE event_type
        WHEN 'purchase' THEN 'PushEvent' WHEN 'signup' THEN 'PullRequestEvent'
        WHEN 'error' THEN 'IssuesEvent' WHEN 'view' THEN 'WatchEvent'
        WHEN 'click' THEN 'ForkEvent' ELSE event_type END AS raw_type,
    CASE WHEN value > 150.0 THEN 'not-a-timestamp'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS raw_created_at,
    CASE WHEN value > 150.0 THEN NULL ELSE CAST(ts AS DATE) END AS event_date,
    CASE WHEN value < 5.0 THEN 'event_id' ELSE 'created_at' END AS reason
FROM events
WHERE value < 5.0 OR value > 150.0""",
        "silver_dedup": _with(_SILVER_CTE)
        + "SELECT * REPLACE (created_at + INTERVAL 1 DAY AS _ingested_at) FROM silver",
        "silver_dedup_by_exception": _with(_SILVER_CTE)
        + "SELECT * REPLACE (CASE WHEN event_id % 10 = 3 THEN created_at + INTERVAL 1 DAY ELSE _ingested_at END AS _ingested_at) FROM silver",
        "silver_incremental_days": _with(_SILVER_CTE)
        + "SELECT * FROM silver WHERE event_date IN (DATE '2024-01-03', DATE '2024-01-04')",
        "stg_events": _with(_SILVER_CTE) + f"SELECT {_STG_COLS} FROM silver",
        "fact_events": _with(_SILVER_CTE) + f"SELECT {_FACT_COLS} FROM silver",
        "dim_repo": _with(_SILVER_CTE) + _DIM_REPO,
        "dim_actor": _with(_SILVER_CTE) + _DIM_ACTOR,
        "dim_date": _with(_SILVER_CTE) + _DIM_DATE,
        "dim_repo_from_activity": _with(_SILVER_CTE) + _DIM_REPO,
        "dim_actor_from_activity": _with(_SILVER_CTE) + _DIM_ACTOR,
        "dim_date_from_activity": _with(_SILVER_CTE) + _DIM_DATE,
        "top_repos": _with(_SILVER_CTE, "repos AS (" + _DIM_REPO + ")")
        + "SELECT repo_id, repo_name, total_events, unique_actors FROM repos "
        "ORDER BY total_events DESC, repo_id LIMIT 10",
        "fact_key_uniqueness": base
        + "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_unique, "
        "count(*) = count(DISTINCT event_id) AS is_unique FROM silver",
        "orphans_repo": _with(_SILVER_CTE, _DIM_REPO_CTE) + orphan_summary.format(k="repo_id", parent="repos"),
        "orphans_actor": _with(_SILVER_CTE, _DIM_ACTOR_CTE) + orphan_summary.format(k="actor_id", parent="actors"),
        "orphans_actor_stale_dim": base
        + f"SELECT actor_id, count(*) AS n_rows FROM silver WHERE actor_id IS NOT NULL "
        f"AND actor_id NOT IN ({actor_snapshot}) GROUP BY actor_id",
        "orphan_rows_actor_stale_dim": base
        + f"SELECT event_id, actor_id, repo_id FROM silver WHERE actor_id IS NOT NULL "
        f"AND actor_id NOT IN ({actor_snapshot})",
        "date_gaps": base
        + "SELECT event_date, count(*) AS n_rows FROM silver WHERE event_date IS NOT NULL AND event_date NOT IN "
        "(SELECT DISTINCT event_date FROM silver WHERE event_date IS NOT NULL) GROUP BY event_date",
        "date_gaps_stale_dim": base
        + "SELECT event_date, count(*) AS n_rows FROM silver WHERE event_date IS NOT NULL AND event_date NOT IN "
        "(SELECT DISTINCT event_date FROM silver WHERE event_date < DATE '2024-01-15') GROUP BY event_date",
        "gold_checks": _with(_SILVER_CTE, _DIM_REPO_CTE, _DIM_ACTOR_CTE)
        + """
SELECT "check", n_bad, n_bad = 0 AS passed FROM (
    SELECT 'fact_event_id_unique' AS "check", count(*) - count(DISTINCT event_id) AS n_bad FROM silver
    UNION ALL
    SELECT 'fact_repo_fk', count(*) FROM silver
    WHERE repo_id IS NOT NULL AND repo_id NOT IN (SELECT repo_id FROM repos)
    UNION ALL
    SELECT 'fact_actor_fk', count(*) FROM silver
    WHERE actor_id IS NOT NULL AND actor_id NOT IN (SELECT actor_id FROM actors)
    UNION ALL
    SELECT 'fact_dates_covered', count(*) FROM silver
    WHERE event_date NOT IN (SELECT DISTINCT event_date FROM silver WHERE event_date IS NOT NULL)
)""",
        "churn_features": features_actor + "SELECT * FROM features",
        "churn_features_from_activity": features_actor + "SELECT * FROM features",
        "churn_features_repo": _with(_SILVER_CTE, _features_sql("repo_id", "actor_id", "2024-01-16", 5))
        + "SELECT * FROM features",
        "churn_split_sizes": features_actor
        + ", split AS (SELECT *, ('0x' || substr(md5(CAST(actor_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 AS b "
        "FROM features) SELECT CASE WHEN b < 70 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM split GROUP BY 1",
        "churn_split_counts": features_actor
        + ", split AS (SELECT *, ('0x' || substr(md5(CAST(actor_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 AS b "
        "FROM features) SELECT count(*) AS total, count(*) FILTER (WHERE churned = 1) AS churned, "
        "count(*) FILTER (WHERE b < 70) AS train_rows, count(*) FILTER (WHERE b >= 70) AS test_rows, "
        "count(*) FILTER (WHERE b >= 70 AND churned = 1) AS test_churned FROM split",
        "churn_rate": features_actor
        + "SELECT count(*) AS total, CAST(coalesce(sum(churned), 0) AS BIGINT) AS churned, "
        "avg(CAST(churned AS DOUBLE)) AS churn_rate FROM features",
        "pruned_partition_count": "SELECT count(*) AS n_events FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
        "flat_date_count": "SELECT count(*) AS n_events FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
        "clustered_lookup": base + "SELECT count(*) AS n_events FROM silver WHERE repo_id = 42",
        "zordered_lookup": base + "SELECT count(*) AS n_events FROM silver WHERE actor_id = 42",
        "bloom_lookup": base + "SELECT count(*) AS n_events FROM silver WHERE actor_id = 42",
        "optimized_lookup": base + "SELECT count(*) AS n_events FROM silver WHERE repo_id = 42",
        "hot_repos": base
        + "SELECT repo_id FROM silver GROUP BY repo_id "
        "HAVING count(*) >= greatest(1, CAST(ceil((SELECT count(*) FROM events) * 0.005) AS BIGINT))",
        "join_broadcast": join_rows,
        "join_shuffle": join_rows,
        "join_auto": join_rows,
        "join_bucketed": join_rows,
        "join_salted": join_rows,
        "join_salted_hot_keys": join_rows,
        "hour_coverage": coverage + "SELECT * FROM cov",
        "daily_coverage": coverage
        + "SELECT event_date, count(*) FILTER (WHERE NOT missing) AS hours_present, "
        "count(*) FILTER (WHERE missing) AS hours_missing, CAST(sum(n_events) AS BIGINT) AS n_events "
        "FROM cov GROUP BY event_date",
        "month_coverage_gaps": _with(
            _SILVER_CTE,
            "grid AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', "
            "TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS hour_start)",
        )
        + "SELECT g.hour_start, CAST(g.hour_start AS DATE) AS event_date, CAST(hour(g.hour_start) AS INTEGER) AS hour, "
        "strftime(g.hour_start, '%Y-%m-%d') || '-' || CAST(hour(g.hour_start) AS VARCHAR) || '.json.gz' AS file_name "
        "FROM grid g WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE date_trunc('hour', s.created_at) = g.hour_start)",
        "bronze_roundtrip": _with(_RAW_CTE)
        + "SELECT id, type, actor_id, actor_login, repo_id, repo_name, payload, public, created_at, event_date FROM raw",
        "silver_from_landed_dumps": base + "SELECT * EXCLUDE (_ingested_at) FROM silver",
        "gold_dim_repo_built": base + _DIM_REPO,
    }
    out.update(
        {
            "sql_fact_events": out["fact_events"],
            "sql_dim_repo": out["dim_repo"],
            "sql_dim_actor": out["dim_actor"],
            "sql_dim_date": out["dim_date"],
            "sql_top_repos": out["top_repos"],
            "sql_fact_uniqueness": base
            + "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_unique FROM silver",
            "sql_orphans_repo": _with(_SILVER_CTE, _DIM_REPO_CTE)
            + "SELECT count(*) AS n FROM silver f WHERE f.repo_id IS NOT NULL "
            "AND NOT EXISTS (SELECT 1 FROM repos r WHERE r.repo_id = f.repo_id)",
            "sql_orphans_actor": _with(_SILVER_CTE, _DIM_ACTOR_CTE)
            + "SELECT count(*) AS n FROM silver f WHERE f.actor_id IS NOT NULL "
            "AND NOT EXISTS (SELECT 1 FROM actors a WHERE a.actor_id = f.actor_id)",
            "sql_date_coverage": base
            + "SELECT count(*) AS n FROM silver f WHERE NOT EXISTS "
            "(SELECT 1 FROM (SELECT DISTINCT event_date FROM silver) d WHERE d.event_date = f.event_date)",
            "streaming_silver_dedup": base + "SELECT * EXCLUDE (_ingested_at) FROM silver",
            "silver_rerun_days": base + "SELECT * EXCLUDE (_ingested_at) FROM silver",
            "gold_incremental_dim_actor": base + _DIM_ACTOR,
            "dim_repo_latest_name": _with(_SILVER_CTE)
            + _DIM_REPO.replace(
                "max(repo_name)                                                               AS repo_name",
                "arg_max(repo_name, (created_at, repo_name))                                  AS repo_name",
            ),
        }
    )
    gaps = coverage.replace("FROM silver", "FROM silver WHERE event_hour NOT IN (5, 17)")
    orphans = "SELECT '{c}' AS \"check\", count(*) AS n FROM silver WHERE {bad}"
    out.update(
        {
            "bronze_string_ids": base + "SELECT * EXCLUDE (_ingested_at) FROM silver",
            "bronze_schema_growth": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'org' || CAST(user_id AS VARCHAR) END AS org_login, "
            "'user' || CAST(user_id AS VARCHAR) AS display_login FROM events",
            "payload_struct_json": "SELECT event_id, replace(props, ' ', '') AS payload_json FROM events",
            "quarantine_incremental": "SELECT CASE WHEN value < 5.0 OR value > 150.0 THEN 'quarantine' ELSE 'silver' END AS place, "
            "CASE WHEN value < 5.0 THEN 'x' ELSE '' END || CAST(event_id AS VARCHAR) AS id, "
            "CASE WHEN value < 5.0 THEN 'event_id' WHEN value > 150.0 THEN 'created_at' END AS reason FROM events",
            "silver_rerun_vanished_day": "SELECT t AS \"table\", CAST(ts AS DATE) AS event_date, count(*) AS n_events "
            "FROM events, (VALUES ('silver'), ('fact_events'), ('activity')) AS k(t) WHERE CAST(ts AS DATE) <> DATE '2024-01-10' GROUP BY 1, 2",
            "fact_built": base + f"SELECT {_FACT_COLS} FROM silver",
            "ledger_rerun": "SELECT count(*) FILTER (WHERE event_id % 2 = 0) AS landed_0, CAST(0 AS BIGINT) AS landed_1, "
            "count(*) FILTER (WHERE event_id % 2 = 1) AS landed_2, count(*) AS bronze_rows FROM events",
            "orphans_repo_stale_dim": base + "SELECT repo_id, count(*) AS n_rows FROM silver WHERE repo_id % 7 = 0 GROUP BY repo_id",
            "sql_orphans_stale_views": base
            + " UNION ALL ".join(
                orphans.format(c=c, bad=bad)
                for c, bad in (("orphans_repo", "repo_id % 7 = 0"), ("orphans_actor", "actor_id % 5 = 0"), ("date_coverage", "day(event_date) = 3"))
            ),
            "hour_coverage_gaps": gaps + "SELECT * FROM cov",
            "dim_repo_renamed": base
            + "SELECT repo_id, max(n) AS repo_name, arg_max(n, (created_at, n)) AS latest_name, count(*) AS total_events, "
            "count(DISTINCT actor_id) AS unique_actors FROM (SELECT *, CASE WHEN day(event_date) > 15 THEN 'a-' || repo_name ELSE repo_name END AS n "
            "FROM silver WHERE event_id % 11 <> 0 AND repo_id IS NOT NULL) GROUP BY repo_id",
            # area under the curve as the rank sum of the churned (ties share their mean rank)
            "churn_fixed_score": features_actor
            + ", scored AS (SELECT churned, 1.0::DOUBLE / (1 + days_active) AS score FROM features), "
            "ranked AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored) "
            "SELECT round(avg(CASE WHEN (score > 0.2) = (churned = 1) THEN 1.0::DOUBLE ELSE 0.0 END), 9) AS accuracy, "
            "round(((sum(r) FILTER (WHERE churned = 1)) - (count(*) FILTER (WHERE churned = 1)) * ((count(*) FILTER (WHERE churned = 1)) + 1) / 2.0) "
            "/ ((count(*) FILTER (WHERE churned = 1)) * (count(*) FILTER (WHERE churned = 0))), 9)::DOUBLE AS roc_auc FROM ranked",
        }
    )
    out["silver_cross_day_replays"] = _with(_SILVER_CTE, _COPIES_CTE) + _NEWEST_COPY.format(where="")
    out["silver_cross_day_vanished"] = _with(_SILVER_CTE, _COPIES_CTE) + _NEWEST_COPY.format(where="WHERE event_date <> DATE '2024-01-10'")
    out["backfill_resumed"] = (
        "SELECT t AS \"table\", CAST(ts AS DATE) AS event_date, count(*) AS n_events "
        "FROM events, (VALUES ('bronze'), ('silver'), ('fact_events')) AS k(t) GROUP BY 1, 2"
    )
    lost = (
        "SELECT \"column\", event_date, count(*) AS n_rows, count(DISTINCT raw) AS n_values, min(raw) AS first_raw, max(raw) AS last_raw FROM ("
        "SELECT 'event_id' AS \"column\", id AS raw, event_date FROM bad_rows WHERE value < 5.0 "
        "UNION ALL SELECT 'created_at', created_at, event_date FROM bad_rows WHERE value > 150.0 "
        "UNION ALL SELECT 'actor_id', 'bad-' || CAST(event_id % 3 AS VARCHAR), event_date FROM bad_rows WHERE event_id % 7 = 0 "
        "UNION ALL SELECT 'repo_id', 'none', event_date FROM bad_rows WHERE event_id % 11 = 0 "
        "UNION ALL SELECT 'public', 'maybe', event_date FROM bad_rows WHERE event_id % 13 = 0) GROUP BY 1, 2"
    )
    out["silver_cast_losses"] = (
        "WITH bad_rows AS (SELECT event_id, value, CASE WHEN value < 5.0 THEN 'x' ELSE '' END || CAST(event_id AS VARCHAR) AS id, "
        "CASE WHEN value > 150.0 THEN 'not-a-timestamp' END AS created_at, CASE WHEN value > 150.0 THEN NULL ELSE CAST(ts AS DATE) END AS event_date FROM events) " + lost
    )
    gone = (
        "event_hour IN (5, 6, 17) OR event_date IN (DATE '2024-01-11', DATE '2024-01-12', DATE '2024-01-13') "
        "OR (event_date = DATE '2024-01-20' AND event_hour > 20) OR (event_date = DATE '2024-01-21' AND event_hour < 4)"
    )
    out["missing_hour_runs"] = coverage.replace(" FROM silver GROUP BY 1", f" FROM silver WHERE NOT ({gone}) GROUP BY 1") + (
        "SELECT min(hour_start) AS first_hour, max(hour_start) AS last_hour, count(*) AS n_hours, count(DISTINCT event_date) AS n_days "
        "FROM (SELECT *, hour_start - row_number() OVER (ORDER BY hour_start) * INTERVAL 1 HOUR AS run FROM cov WHERE missing) GROUP BY run"
    )
    # a fit that has converged has no slope left
    terms = ("intercept", *FEATURE_COLUMNS)
    out["churn_fit_conditions"] = " UNION ALL ".join(f"SELECT '{t}' AS term, CAST(0 AS BIGINT) AS thousandths" for t in terms)
    out["churn_batch_scores"] = features_actor + "SELECT actor_id, n_events, churned, true AS as_formula, true AS as_score FROM features"
    out["bronze_member_columns"] = (
        "SELECT event_id, CASE WHEN day(ts) >= 10 THEN event_id % 7 END AS org_id, CASE WHEN day(ts) >= 10 THEN 'org' || CAST(user_id AS VARCHAR) END AS org_login, "
        "CASE WHEN day(ts) >= 20 AND event_id % 3 = 0 THEN CAST(event_id % 50 AS DOUBLE) + CASE WHEN event_id % 2 = 0 THEN 0.0 ELSE 0.5 END END AS score, "
        "CASE WHEN event_id % 5 = 0 THEN 'https://example.invalid/' || CAST(user_id AS VARCHAR) END AS site FROM events"
    )
    member = "SELECT '{m}' AS member, '{t}' AS value_type, min(CAST(ts AS DATE)) AS first_day, count(*) AS n_rows FROM events WHERE {w}"
    out["bronze_new_members"] = " UNION ALL ".join(
        member.format(m=m, t=t, w=w)
        for m, t, w in (
            ("org", "OBJECT<id: BIGINT, login: STRING>", "day(ts) >= 10"),
            ("score", "OBJECT<v: DECIMAL(21,1)>", "day(ts) >= 20 AND event_id % 3 = 0"),
            ("actor", "OBJECT<site: STRING>", "event_id % 5 = 0"),
        )
    )
    # every eleventh event has no repository; two days were run again with fewer events, whose repositories are renamed
    forward = _with(
        _SILVER_CTE.replace("silver AS", "events_all AS"),
        """silver AS (
    SELECT * REPLACE (CASE WHEN event_id % 11 <> 0 THEN repo_id END AS repo_id,
        CASE WHEN event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' THEN 'z-' || repo_name ELSE repo_name END AS repo_name)
    FROM events_all
    WHERE event_date NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' OR (event_id % 3 <> 1 AND event_hour < 20)
)""",
    )
    out["gold_forward_dim_repo"] = forward + _DIM_REPO
    out["gold_forward_dim_actor"] = forward + _DIM_ACTOR
    out.update(_quality_oracles())
    out["run_report"] = f'SELECT layer, expectation, "column", mostly, evaluated, unexpected, success FROM ({out["quality_report"]})'
    if registry is not None:
        out |= registry.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
