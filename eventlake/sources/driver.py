"""Adapters from the shared test tables to the pipeline's raw / Silver shapes.

The test data ships an ``events`` table (``event_id, ts, user_id, event_type,
value, props``). The mapping below turns it into archive-shaped raw rows so the
whole pipeline (normalise, dedup, marts, checks, features) runs on it:

* ``actor_id = user_id``, ``actor_login = 'user' || user_id``
* ``repo_id = props.k``, ``repo_name = 'repo' || repo_id``
* ``payload = props``, ``public = true``, ``created_at = ts`` (ISO-8601, UTC)
* ``_ingested_at = ts + 1 hour`` (a dump lands after its hour closes)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.silver import normalize
from eventlake.schema import BRONZE_SCHEMA

# Test-table event types -> archive event types.
EVENT_TYPE_MAP: dict[str, str] = {
    "purchase": "PushEvent",
    "signup": "PullRequestEvent",
    "error": "IssuesEvent",
    "view": "WatchEvent",
    "click": "ForkEvent",
}

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")


def mapped_type(col: Column) -> Column:
    out: Column | None = None
    for src, dst in EVENT_TYPE_MAP.items():
        out = F.when(col == F.lit(src), F.lit(dst)) if out is None else out.when(col == F.lit(src), F.lit(dst))
    return out.otherwise(col) if out is not None else col


def events_as_raw(
    events: DataFrame,
    id_col: Column | None = None,
    created_col: Column | None = None,
    ingest_delay: str = "INTERVAL 1 HOUR",
) -> DataFrame:
    """Archive-shaped Bronze rows (raw envelope + ``event_date`` + ``_ingested_at``)."""
    repo_id = F.get_json_object(F.col("props"), "$.k").try_cast("bigint")
    login = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    repo_name = F.concat(F.lit("repo"), repo_id.cast("string"))
    created = created_col if created_col is not None else F.date_format(F.col("ts"), ISO_FORMAT)
    return events.select(
        (id_col if id_col is not None else F.col("event_id").cast("string")).alias("id"),
        mapped_type(F.col("event_type")).alias("type"),
        F.struct(
            F.col("user_id").alias("id"),
            login.alias("login"),
            login.alias("display_login"),
            F.concat(F.lit("https://example.invalid/users/"), login).alias("url"),
        ).alias("actor"),
        F.struct(
            repo_id.alias("id"),
            repo_name.alias("name"),
            F.concat(F.lit("https://example.invalid/repos/"), repo_name).alias("url"),
        ).alias("repo"),
        F.col("props").alias("payload"),
        F.lit(True).alias("public"),
        created.alias("created_at"),
        F.to_date(F.try_to_timestamp(created)).alias("event_date"),
        (F.col("ts").cast("timestamp") + F.expr(ingest_delay)).alias("_ingested_at"),
    )


def events_as_silver(events: DataFrame) -> DataFrame:
    """Silver rows for the test events (raw mapping + :func:`normalize`)."""
    return normalize(events_as_raw(events))


def events_replayed(events: DataFrame) -> DataFrame:
    """Bronze as if every hourly dump had been landed twice: the first landing
    an hour after the events, the replay one day later. Dedup must keep the
    replayed copy of every event."""
    first = events_as_raw(events)
    replay = events_as_raw(events, ingest_delay="INTERVAL 1 DAY")
    return first.unionByName(replay)


def events_with_bad_rows(events: DataFrame) -> DataFrame:
    """Raw rows where low-value events carry a letter-prefixed id and
    high-value events an unparseable ``created_at`` (all rows processed)."""
    bad_id = F.when(F.col("value") < F.lit(5.0), F.concat(F.lit("x"), F.col("event_id").cast("string")))
    bad_ts = F.when(F.col("value") > F.lit(150.0), F.lit("not-a-timestamp"))
    return events_as_raw(
        events,
        id_col=F.coalesce(bad_id, F.col("event_id").cast("string")),
        created_col=F.coalesce(bad_ts, F.date_format(F.col("ts"), ISO_FORMAT)),
    )


def as_bronze(raw: DataFrame) -> DataFrame:
    """Raw rows in the types of landed Bronze (missing columns are NULL)."""
    return raw.select(*[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields])


def dump_lines(raw: DataFrame, extra: dict[str, Column] | None = None, text_ids: Column | None = None) -> DataFrame:
    """One JSON line per raw row, as dumps hold them.

    ``extra``: further top-level members (left out where NULL). ``text_ids``:
    where true, ids and the public flag are written as strings.
    """
    names = ["id", "type", "actor", "repo", "payload", "public", "created_at"]
    rows = raw.withColumns({k: c for k, c in (extra or {}).items()})
    members = names + list(extra or {})
    plain = F.to_json(F.struct(*members))
    if text_ids is None:
        return rows.select(plain.alias("value"))
    as_text = {
        "actor": F.col("actor").withField("id", F.col("actor.id").cast("string")),
        "repo": F.col("repo").withField("id", F.col("repo.id").cast("string")),
        "public": F.col("public").cast("string"),
    }
    quoted = F.to_json(F.struct(*[as_text[m].alias(m) if m in as_text else F.col(m) for m in members]))
    return rows.select(F.when(text_ids, quoted).otherwise(plain).alias("value"))
