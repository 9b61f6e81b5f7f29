"""Layer contracts: raw envelope, Silver, Gold marts, churn features.

The contract check compares names, types and (optionally) column order of a
DataFrame against a ``StructType``. NULLs in the required Silver columns are
removed by the Silver filter, so nullability is declared here and enforced there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

CORRUPT_COLUMN = "_corrupt_record"

#: Raw hourly-dump envelope as landed. Ids and booleans stay text, as dumps
#: write them either way; Silver casts them. ``payload`` keeps its JSON text.


def _texts(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


RAW_SCHEMA = StructType(
    [
        *_texts("id", "type").fields,
        StructField("actor", _texts("id", "login", "display_login", "url")),
        StructField("repo", _texts("id", "name", "url")),
        *_texts("payload", "public", "created_at").fields,
    ]
)

#: The column of a record's members beyond the envelope, with their types.
FURTHER_COLUMN = "further"

#: Raw envelope plus the columns for unparseable lines and for further members.
RAW_READ_SCHEMA = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType()), StructField(FURTHER_COLUMN, MapType(StringType(), VariantType()))])

#: Columns Bronze adds on top of the raw envelope.
BRONZE_EXTRA = StructType(
    [
        StructField("event_date", DateType()),
        StructField("_ingested_at", TimestampType()),
    ]
)

#: Bronze as written by landing: envelope (+ corrupt-record column) and the
#: two ingest columns. Reading with it needs no footer merge and reads columns
#: absent from older files as NULL.
BRONZE_SCHEMA = StructType(RAW_READ_SCHEMA.fields + BRONZE_EXTRA.fields)

# The Silver contract (names, types, order).
SILVER_SCHEMA = StructType(
    [
        StructField("event_id", LongType(), nullable=False),
        StructField("event_type", StringType(), nullable=False),
        StructField("actor_id", LongType(), nullable=True),
        StructField("actor_login", StringType(), nullable=True),
        StructField("repo_id", LongType(), nullable=True),
        StructField("repo_name", StringType(), nullable=True),
        StructField("payload_json", StringType(), nullable=True),
        StructField("public", BooleanType(), nullable=True),
        StructField("created_at", TimestampType(), nullable=False),
        StructField("event_date", DateType(), nullable=False),
        StructField("event_hour", IntegerType(), nullable=False),
        StructField("_ingested_at", TimestampType(), nullable=True),
        StructField("_silver_processed_at", TimestampType(), nullable=False),
    ]
)
SILVER_COLUMNS: tuple[str, ...] = tuple(f.name for f in SILVER_SCHEMA.fields)

# Columns of the staging view (Silver without its two audit columns), the fact and the dimensions.
STG_COLUMNS: tuple[str, ...] = (
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "payload_json",
    "public",
    "created_at",
    "event_date",
    "event_hour",
)

FACT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("event_type", StringType()),
        StructField("repo_id", LongType()),
        StructField("actor_id", LongType()),
        StructField("event_date", DateType()),
        StructField("event_hour", IntegerType()),
        StructField("created_at", TimestampType()),
        StructField("public", BooleanType()),
    ]
)
FACT_COLUMNS: tuple[str, ...] = tuple(f.name for f in FACT_SCHEMA.fields)

#: Day-grained rollup shared by the dimensions and the churn features.
ACTIVITY_SCHEMA = StructType(
    [
        StructField("repo_id", LongType()),
        StructField("actor_id", LongType()),
        StructField("event_date", DateType()),
        StructField("event_type", StringType()),
        StructField("repo_name", StringType()),
        StructField("actor_login", StringType()),
        StructField("n_events", LongType()),
        StructField("first_seen_at", TimestampType()),
        StructField("last_seen_at", TimestampType()),
    ]
)

DIM_REPO_SCHEMA = StructType(
    [
        StructField("repo_id", LongType()),
        StructField("repo_name", StringType()),
        StructField("first_seen_at", TimestampType()),
        StructField("last_seen_at", TimestampType()),
        StructField("total_events", LongType()),
        StructField("unique_actors", LongType()),
        StructField("active_days", LongType()),
        StructField("push_events", LongType()),
        StructField("pr_events", LongType()),
        StructField("issue_events", LongType()),
        StructField("watch_events", LongType()),
        StructField("fork_events", LongType()),
    ]
)

DIM_ACTOR_SCHEMA = StructType(
    [
        StructField("actor_id", LongType()),
        StructField("actor_login", StringType()),
        StructField("first_seen_at", TimestampType()),
        StructField("last_seen_at", TimestampType()),
        StructField("total_events", LongType()),
        StructField("unique_repos", LongType()),
        StructField("active_days", LongType()),
        StructField("distinct_event_types", LongType()),
    ]
)

DIM_DATE_SCHEMA = StructType(
    [
        StructField("date_key", DateType()),
        StructField("year", IntegerType()),
        StructField("quarter", IntegerType()),
        StructField("month", IntegerType()),
        StructField("day", IntegerType()),
        StructField("day_of_week", IntegerType()),
        StructField("week_of_year", IntegerType()),
        StructField("is_weekend", BooleanType()),
    ]
)

# Names of the churn features and of the label.
FEATURE_COLUMNS: tuple[str, ...] = (
    "n_events",
    "n_actors",
    "n_event_types",
    "days_active",
    "push_ratio",
    "pr_ratio",
    "issue_ratio",
)
LABEL_COLUMN = "churned"

def features_schema(entity: str = "repo_id") -> StructType:
    """Churn feature table: the entity key, 4 counts, 3 ratios, the label."""
    return StructType(
        [StructField(entity, LongType())]
        + [StructField(c, LongType()) for c in FEATURE_COLUMNS[:4]]
        + [StructField(c, DoubleType()) for c in FEATURE_COLUMNS[4:]]
        + [StructField(LABEL_COLUMN, IntegerType())]
    )


FEATURES_SCHEMA = features_schema()


class ContractError(ValueError):
    """A DataFrame does not satisfy a layer contract."""


def _type_name(t: DataType) -> str:
    return t.simpleString()


def contract_violations(df: DataFrame, contract: StructType) -> list[str]:
    """Return human-readable violations (missing columns, wrong types)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems: list[str] = []
    missing = sorted(f.name for f in contract.fields if f.name not in actual)
    if missing:
        problems.append(f"missing columns: {missing}")
    for field in contract.fields:
        got = actual.get(field.name)
        if got is not None and got != field.dataType:
            problems.append(
                f"column {field.name!r} has type {_type_name(got)}, expected {_type_name(field.dataType)}"
            )
    return problems


def check_contract(df: DataFrame, contract: StructType, *, name: str = "table") -> DataFrame:
    """Raise :class:`ContractError` unless ``df`` carries every contract column
    with the contract type; return ``df`` projected to the contract order."""
    problems = contract_violations(df, contract)
    if problems:
        raise ContractError(f"{name} violates its contract: " + "; ".join(problems))
    return df.select(*[f.name for f in contract.fields])
