"""Exact incremental upkeep of the repository and actor dimensions.

A distinct count can't be added up over days, so a dimension row alone can't be
brought forward. The *member table* of a dimension can: it holds each entity's
sets exactly, one row per (entity, set, member) with the number of days the member
occurs on. It is partitioned by a hash bucket of the entity. A run of some days

* takes the difference of those days' new and old rollup, per entity (event
  counts) and per member (days),
* adds it to the members in the buckets it touches (a member on no day goes),
* counts the sets of the touched entities again and merges sums, first and last
  times into their dimension rows; all other rows stay as they are.

So it reads the rollup of its own days, the touched buckets and the dimension, no
matter how many days there are. Only an entity that had rows in the days before
they were replaced may have lost its first or last time: those few look it up in
the rollup again. All work is grouped by (entity, member) with partial
aggregation, so an entity that a third of all events share is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.functions.columns import EVENT_TYPE_COLUMNS, count_of_type
from eventlake.schema import DIM_ACTOR_SCHEMA, DIM_REPO_SCHEMA

BUCKETS = 32
MEMBER_KEYS = ("entity", "kind", "member_id", "member_text")
MEMBERS_SCHEMA = "entity bigint, kind string, member_id bigint, member_text string, n_days bigint, bucket int"


@dataclass(frozen=True)
class Dimension:
    """What a dimension keeps per entity: distinct counts (column -> member), a name, counts of event types."""

    key: str
    schema: StructType
    name: str
    distinct: Mapping[str, str]
    type_counts: Mapping[str, str] = field(default_factory=dict)


REPO = Dimension("repo_id", DIM_REPO_SCHEMA, "repo_name", {"unique_actors": "actor_id", "active_days": "event_date"}, EVENT_TYPE_COLUMNS)
ACTOR = Dimension("actor_id", DIM_ACTOR_SCHEMA, "actor_login", {"unique_repos": "repo_id", "active_days": "event_date", "distinct_event_types": "event_type"})
DIMENSIONS = {"dim_repo": REPO, "dim_actor": ACTOR}


def _member(rollup: DataFrame, kind: str, column: str) -> Column:
    as_text = rollup.schema[column].dataType.simpleString() == "string"
    number = F.unix_date(column) if column == "event_date" else F.lit(None) if as_text else F.col(column)
    text = F.col(column) if as_text else F.lit(None)
    return F.struct(F.lit(kind).alias("kind"), number.cast("bigint").alias("member_id"), text.cast("string").alias("member_text"))


def members(rollup: DataFrame, dim: Dimension) -> DataFrame:
    """(entity, kind, member_id, member_text, n_days): the sets of every entity in some days' rollup; NULL is no member."""
    sets = [_member(rollup, kind, column) for kind, column in dim.distinct.items()] + [_member(rollup, dim.name, dim.name)]
    each = rollup.where(F.col(dim.key).isNotNull()).select(F.col(dim.key).alias("entity"), "event_date", F.explode(F.array(*sets)).alias("m"))
    each = each.select("entity", "event_date", "m.*").where(F.col("member_id").isNotNull() | F.col("member_text").isNotNull())
    return each.distinct().groupBy(*MEMBER_KEYS).agg(F.count(F.lit(1)).alias("n_days"))


def with_bucket(table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return table.withColumn("bucket", F.pmod(F.xxhash64("entity"), F.lit(buckets)).cast("int"))


def measures(rollup: DataFrame, dim: Dimension) -> DataFrame:
    """Sums, first and last time per entity of some days' rollup."""
    weight = F.col("n_events")
    return (
        rollup.where(F.col(dim.key).isNotNull())
        .groupBy(F.col(dim.key).alias("entity"))
        .agg(
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            F.sum("n_events").cast("bigint").alias("total_events"),
            *[count_of_type(t, weight=weight).alias(c) for c, t in dim.type_counts.items()],
        )
    )


def _difference(new: DataFrame, old: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """new - old of the summed columns per key; keys match where both are NULL."""
    signed = new.select(*keys, *sums).unionAll(old.select(*keys, *[(-F.col(c)).alias(c) for c in sums]))
    return signed.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])


def member_changes(new: DataFrame, old: DataFrame, dim: Dimension) -> DataFrame:
    """Days that members gain (or lose, if negative) when some days' rollup ``old`` becomes ``new``."""
    return with_bucket(_difference(members(new, dim), members(old, dim), list(MEMBER_KEYS), ["n_days"])).where("n_days <> 0")


def merge_members(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The member table (of some buckets) after the changes."""
    both = state.select(*MEMBER_KEYS, "bucket", "n_days").unionByName(changes.select(*MEMBER_KEYS, "bucket", "n_days"))
    return both.groupBy(*MEMBER_KEYS, "bucket").agg(F.sum("n_days").cast("bigint").alias("n_days")).where("n_days > 0")


def set_sizes(state: DataFrame, dim: Dimension) -> DataFrame:
    """Distinct counts and display name per entity, from its members."""
    counts = [F.count_if(F.col("kind") == kind).alias(kind) for kind in dim.distinct]
    sizes = state.groupBy("entity").agg(*counts)
    names = state.where(F.col("kind") == dim.name).groupBy("entity").agg(F.max("member_text").alias(dim.name))
    return sizes.join(names, "entity", "left")


def merge_dimension(table: DataFrame, state: DataFrame, new: DataFrame, old: DataFrame, rollup: DataFrame | None, dim: Dimension) -> DataFrame:
    """The dimension after some days' rollup ``old`` became ``new``.

    ``state``: the merged member table of (at least) the touched entities;
    ``rollup``: all days, read only for entities that ``old`` has (None if it is empty).
    """
    sums = ["total_events", *dim.type_counts]
    plus, minus = measures(new, dim), measures(old, dim)
    change = _difference(plus, minus, ["entity"], sums)
    had = minus.select(F.col("entity").alias(dim.key))
    again = minus if rollup is None else measures(rollup.join(had, dim.key, "left_semi"), dim)
    again = again.select("entity", F.col("first_seen_at").alias("first_again"), F.col("last_seen_at").alias("last_again"))
    times = plus.select("entity", F.col("first_seen_at").alias("first_new"), F.col("last_seen_at").alias("last_new"))
    before = table.withColumnRenamed(dim.key, "entity").select("entity", "first_seen_at", "last_seen_at", *sums)
    before = before.select("entity", F.col("first_seen_at").alias("first_old"), F.col("last_seen_at").alias("last_old"), *[F.col(c).alias(f"old_{c}") for c in sums])
    rows = change.join(before, "entity", "left").join(times, "entity", "left").join(again, "entity", "left")
    rows = rows.join(set_sizes(state.join(change.select("entity"), "entity", "left_semi"), dim), "entity", "left")
    # an entity looked up again has its times from the rollup alone, others from before and now
    first = F.coalesce("first_again", F.least("first_old", "first_new"))
    last = F.coalesce("last_again", F.greatest("last_old", "last_new"))
    merged = rows.select(
        F.col("entity").alias(dim.key),
        first.alias("first_seen_at"),
        last.alias("last_seen_at"),
        *[(F.coalesce(F.col(f"old_{c}"), F.lit(0)) + F.col(c)).cast("bigint").alias(c) for c in sums],
        *dim.distinct,
        dim.name,
    ).where("total_events > 0")
    untouched = table.join(change.select(F.col("entity").alias(dim.key)), dim.key, "left_anti")
    columns = dim.schema.fieldNames()
    return untouched.select(*columns).unionByName(merged.select(*columns))
