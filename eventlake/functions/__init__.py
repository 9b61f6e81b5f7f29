"""Reusable column expressions (all built-in Spark functions, JVM-side)."""

from eventlake.functions.columns import (
    EVENT_TYPE_COLUMNS,
    KNOWN_EVENT_TYPES,
    calendar_columns,
    count_of_type,
    hash_bucket,
    parse_timestamp,
    safe_cast,
)

__all__ = [
    "EVENT_TYPE_COLUMNS",
    "KNOWN_EVENT_TYPES",
    "calendar_columns",
    "count_of_type",
    "hash_bucket",
    "parse_timestamp",
    "safe_cast",
]
