"""Column expressions shared by the layers.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

# ---------------------------------------------------------------------------
# Event type names of the public event archive. They must equal
# the names used by the data, by the mart columns and by the quality suite.
# ---------------------------------------------------------------------------
KNOWN_EVENT_TYPES: tuple[str, ...] = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "ForkEvent",
    "CreateEvent",
    "DeleteEvent",
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "ReleaseEvent",
    "PublicEvent",
    "MemberEvent",
    "GollumEvent",
    "CommitCommentEvent",
)

#: Mart column -> event type it counts (fixed values of the repo dimension).
EVENT_TYPE_COLUMNS: dict[str, str] = {
    "push_events": "PushEvent",
    "pr_events": "PullRequestEvent",
    "issue_events": "IssuesEvent",
    "watch_events": "WatchEvent",
    "fork_events": "ForkEvent",
}


def safe_cast(col: Column | str, to: DataType | str) -> Column:
    """Cast that yields NULL on malformed input (ANSI mode would raise)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(to)


def parse_timestamp(col: Column, source_type: DataType) -> Column:
    """ISO-8601 text (``2024-01-01T00:00:00Z``) or a timestamp -> TIMESTAMP.

    Unparseable text becomes NULL instead of failing the job.
    """
    if isinstance(source_type, StringType):
        return F.try_to_timestamp(col)
    if isinstance(source_type, (TimestampType, TimestampNTZType)):
        return col.cast(TimestampType())
    return col.try_cast(TimestampType())


def count_of_type(event_type: str, type_col: str = "event_type", weight: Column | None = None) -> Column:
    """Number of rows (or sum of ``weight``) whose type equals ``event_type``."""
    hit = F.col(type_col) == F.lit(event_type)
    if weight is None:
        return F.count_if(hit)
    return F.sum(F.when(hit, weight).otherwise(F.lit(0))).cast("bigint")


def calendar_columns(date_col: str = "date_key") -> list[Column]:
    """Calendar attributes of a DATE column (Sunday = 1, ISO week)."""
    d = F.col(date_col)
    dow = F.dayofweek(d)
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def hash_bucket(cols: list[str], seed: int, buckets: int = 100) -> Column:
    """Deterministic bucket in ``[0, buckets)`` of a key, independent of the
    partitioning and row order (unlike ``randomSplit``).

    Built from the first 32 bits of ``md5("<key>:<seed>")``, so any engine
    with ``md5`` can reproduce the split (the SQL oracle does).
    """
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))
