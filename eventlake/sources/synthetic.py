"""Deterministic synthetic events for layout benchmarks.

Shape of the layout benchmark input: ``event_id`` 0..n-1, type
alternating Push / PullRequest, ``repo_id`` in ``[0, n_repos)``,
``event_date`` cycling over 28 days of January 2024, ``event_hour = i % 24``
-- but generated by ``spark.range`` on the executors (no driver-side list),
with the repo drawn from a hash of the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_events(spark: SparkSession, n_rows: int, n_repos: int = 1000, seed: int = 42) -> DataFrame:
    i = F.col("id")
    return spark.range(n_rows).select(
        i.alias("event_id"),
        F.when(i % 2 == 0, F.lit("PushEvent")).otherwise(F.lit("PullRequestEvent")).alias("event_type"),
        F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(n_repos)).alias("repo_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 28).cast("int")).alias("event_date"),
        (i % 24).cast("int").alias("event_hour"),
    )
