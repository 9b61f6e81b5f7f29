"""The Gold models as Spark SQL over temp views (the "executable spec" form).

``create_views`` registers ``silver_events`` and then one
``CREATE OR REPLACE TEMP VIEW`` per model, in dependency order; the views are
plain SQL, so Catalyst inlines them (hash aggregates, string maxima from (key,
name) pairs). ``VALIDATION_SQL`` holds the checks run over the views; they count
the fact per key first, so the anti-joins move keys instead of events (the
``n_rows > 0`` in the join condition keeps the count below the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.sources.tables import register_view

STG_EVENTS = """
SELECT event_id, event_type, actor_id, actor_login, repo_id, repo_name,
       payload_json, public, created_at, event_date, event_hour
FROM silver_events
"""

FACT_EVENTS = """
SELECT event_id, event_type, repo_id, actor_id, event_date, event_hour, created_at, public
FROM stg_events
"""

DIM_REPO = """
WITH metrics AS (
    SELECT
        repo_id,
        min(created_at)                                                   AS first_seen_at,
        max(created_at)                                                   AS last_seen_at,
        count(*)                                                          AS total_events,
        count(DISTINCT actor_id)                                          AS unique_actors,
        count(DISTINCT event_date)                                        AS active_days,
        count_if(event_type = 'PushEvent')                                AS push_events,
        count_if(event_type = 'PullRequestEvent')                         AS pr_events,
        count_if(event_type = 'IssuesEvent')                              AS issue_events,
        count_if(event_type = 'WatchEvent')                               AS watch_events,
        count_if(event_type = 'ForkEvent')                                AS fork_events
    FROM stg_events
    WHERE repo_id IS NOT NULL
    GROUP BY repo_id
),
names AS (
    -- the pair count keeps the inner aggregate from being folded away
    SELECT repo_id, max(CASE WHEN n > 0 THEN repo_name END) AS repo_name
    FROM (SELECT repo_id, repo_name, count(*) AS n FROM stg_events WHERE repo_id IS NOT NULL GROUP BY repo_id, repo_name)
    GROUP BY repo_id
)
SELECT m.repo_id, n.repo_name, m.first_seen_at, m.last_seen_at, m.total_events, m.unique_actors,
       m.active_days, m.push_events, m.pr_events, m.issue_events, m.watch_events, m.fork_events
FROM metrics m LEFT JOIN names n ON m.repo_id = n.repo_id
"""

DIM_ACTOR = """
WITH metrics AS (
    SELECT
        actor_id,
        min(created_at)            AS first_seen_at,
        max(created_at)            AS last_seen_at,
        count(*)                   AS total_events,
        count(DISTINCT repo_id)    AS unique_repos,
        count(DISTINCT event_date) AS active_days,
        count(DISTINCT event_type) AS distinct_event_types
    FROM stg_events
    WHERE actor_id IS NOT NULL
    GROUP BY actor_id
),
names AS (
    SELECT actor_id, max(CASE WHEN n > 0 THEN actor_login END) AS actor_login
    FROM (SELECT actor_id, actor_login, count(*) AS n FROM stg_events WHERE actor_id IS NOT NULL GROUP BY actor_id, actor_login)
    GROUP BY actor_id
)
SELECT m.actor_id, n.actor_login, m.first_seen_at, m.last_seen_at, m.total_events,
       m.unique_repos, m.active_days, m.distinct_event_types
FROM metrics m LEFT JOIN names n ON m.actor_id = n.actor_id
"""

DIM_DATE = """
SELECT
    d AS date_key,
    year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
    dayofweek(d) AS day_of_week,          -- Sunday = 1
    weekofyear(d) AS week_of_year,        -- ISO week
    dayofweek(d) IN (1, 7) AS is_weekend
FROM (SELECT DISTINCT event_date AS d FROM stg_events WHERE event_date IS NOT NULL)
"""

#: model name -> SQL, in dependency order
MODELS: dict[str, str] = {
    "stg_events": STG_EVENTS,
    "fact_events": FACT_EVENTS,
    "dim_repo": DIM_REPO,
    "dim_actor": DIM_ACTOR,
    "dim_date": DIM_DATE,
}

VALIDATION_SQL: dict[str, str] = {
    "fact_uniqueness": "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_unique FROM fact_events",
    "orphans_repo": """
        SELECT coalesce(sum(n_rows), 0) AS n
        FROM (SELECT repo_id, count(*) AS n_rows FROM fact_events WHERE repo_id IS NOT NULL GROUP BY repo_id) f
        LEFT ANTI JOIN dim_repo r ON f.repo_id = r.repo_id AND f.n_rows > 0""",
    "orphans_actor": """
        SELECT coalesce(sum(n_rows), 0) AS n
        FROM (SELECT actor_id, count(*) AS n_rows FROM fact_events WHERE actor_id IS NOT NULL GROUP BY actor_id) f
        LEFT ANTI JOIN dim_actor a ON f.actor_id = a.actor_id AND f.n_rows > 0""",
    "date_coverage": """
        SELECT coalesce(sum(n_rows), 0) AS n
        FROM (SELECT event_date, count(*) AS n_rows FROM fact_events GROUP BY event_date) f
        LEFT ANTI JOIN dim_date d ON f.event_date = d.date_key AND f.n_rows > 0""",
    "top_repos": """
        SELECT repo_id, repo_name, total_events, unique_actors
        FROM dim_repo
        ORDER BY total_events DESC, repo_id
        LIMIT 10""",
}


def create_views(spark: SparkSession, silver: DataFrame) -> dict[str, DataFrame]:
    """Register ``silver_events`` and every model as a temp view."""
    register_view(silver, "silver_events")
    out = {}
    for name, sql in MODELS.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {sql}")
        out[name] = spark.table(name)
    return out


def validate(spark: SparkSession, name: str) -> DataFrame:
    """Run one of :data:`VALIDATION_SQL` over the registered views."""
    return spark.sql(VALIDATION_SQL[name])
