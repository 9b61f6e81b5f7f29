"""Gold validation: fact key uniqueness, referential integrity, date coverage.

Every check pre-aggregates the fact to its distinct keys (partial aggregation
before the shuffle) and only then anti-joins the parent, so a key that holds a
third of the fact costs one row per map task, and the join moves keys, not
events. Spark/AQE pick broadcast or sort-merge for the anti-join from the
measured size of the parent keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_uniqueness(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: ``n_rows``, ``n_unique`` (distinct non-NULL keys) and ``is_unique``."""
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(key)).alias("n_unique"))
        .withColumn("is_unique", F.col("n_rows") == F.col("n_unique"))
    )


def key_counts(child: DataFrame, key: str) -> DataFrame:
    """Rows per non-NULL key of ``child``."""
    return child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def keys_missing_from(counts: DataFrame, parent_keys: DataFrame, key: str) -> DataFrame:
    """Rows of the per-key ``counts`` whose key is not in ``parent_keys``.

    The join condition also reads the aggregated ``n_rows`` (always > 0), so
    the optimizer cannot push the anti-join below the aggregation: the join
    then moves one row per key, never the raw child rows, whichever join
    strategy is picked.
    """
    pk = parent_keys.select(F.col(key).alias("_pk"))
    cond = (counts[key] == pk["_pk"]) & (counts["n_rows"] > F.lit(0))
    return counts.join(pk, cond, "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Non-NULL child keys absent from the parent, with their child row counts."""
    pk = parent_key or key
    parent_keys = parent.select(F.col(pk).alias(key)).where(F.col(key).isNotNull())
    return keys_missing_from(key_counts(child, key), parent_keys, key)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (``LEFT JOIN ... IS NULL``)."""
    pk = parent_key or key
    parent_keys = parent.select(F.col(pk).alias(key)).where(F.col(key).isNotNull())
    return child.where(F.col(key).isNotNull()).join(parent_keys, key, "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """One row: ``n_orphan_rows`` and ``n_orphan_keys`` (0 and 0 when the FK holds)."""
    return orphan_keys(child, parent, key, parent_key).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_orphan_rows"),
        F.count(F.lit(1)).alias("n_orphan_keys"),
    )


def date_gaps(fact: DataFrame, dates: DataFrame, date_col: str = "event_date", key: str = "date_key") -> DataFrame:
    """Fact dates missing from the date dimension, with their row counts."""
    counts = key_counts(fact, date_col)
    return keys_missing_from(counts, dates.select(F.col(key).alias(date_col)), date_col)


def gold_checks(fact: DataFrame, repos: DataFrame, actors: DataFrame, dates: DataFrame) -> DataFrame:
    """All Gold validation results as rows ``check, n_bad, passed``."""
    uniq = key_uniqueness(fact).select(
        F.lit("fact_event_id_unique").alias("check"),
        (F.col("n_rows") - F.col("n_unique")).alias("n_bad"),
    )
    repo = orphan_summary(fact, repos, "repo_id").select(
        F.lit("fact_repo_fk").alias("check"), F.col("n_orphan_rows").alias("n_bad")
    )
    actor = orphan_summary(fact, actors, "actor_id").select(
        F.lit("fact_actor_fk").alias("check"), F.col("n_orphan_rows").alias("n_bad")
    )
    gaps = date_gaps(fact, dates).agg(
        F.lit("fact_dates_covered").alias("check"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_bad"),
    )
    return uniq.unionByName(repo).unionByName(actor).unionByName(gaps).withColumn("passed", F.col("n_bad") == 0)
