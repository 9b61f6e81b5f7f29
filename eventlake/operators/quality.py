"""Data-quality suites per layer, evaluated in as few passes as Spark allows.

An expectation is a small spec (not-null, unique, in-set with ``mostly``,
between, relationship). :func:`evaluate` turns a suite into:

* **one** global aggregate for all row-level checks of a table (not-null,
  in-set, between): a single scan, no shuffle;
* one grouped pass per ``unique`` column (partial aggregation first);
* one pre-aggregated anti-join per ``relationship``.

Results are a DataFrame with one row per expectation; :func:`summarize` rolls
them up per layer and :func:`assert_quality` is the gate.

Value semantics: NULLs are ignored by every check except not-null; every row
of a duplicated key is unexpected; range ends are inclusive; success means
``(evaluated - unexpected) >= mostly * evaluated``; an empty input passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.columns import KNOWN_EVENT_TYPES
from eventlake.operators.validation import key_counts, keys_missing_from
from eventlake.schema import BRONZE_SCHEMA, FACT_SCHEMA, SILVER_SCHEMA
from eventlake.sources.tables import read_table, table_exists

RESULT_COLUMNS = (
    "layer",
    "expectation",
    "column",
    "mostly",
    "evaluated",
    "unexpected",
    "unexpected_percent",
    "success",
)


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    mostly: float = 1.0
    value_set: tuple = ()
    min_value: object = None
    max_value: object = None
    parent: str | None = None  # relationship: name of the parent table
    parent_column: str | None = None
    where: str | None = None  # relationship row filter (SQL text)
    name: str = field(default="")

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}({self.column})"


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def in_set(column: str, values: Iterable, mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, mostly=mostly, value_set=tuple(values))


def between(column: str, min_value, max_value, mostly: float = 1.0) -> Expectation:
    return Expectation("between", column, mostly=mostly, min_value=min_value, max_value=max_value)


def relationship(column: str, parent: str, parent_column: str | None = None, where: str | None = None) -> Expectation:
    return Expectation("relationship", column, parent=parent, parent_column=parent_column or column, where=where)


# ---------------------------------------------------------------------------
# suites (fixed values: the checks of each layer and model)
# ---------------------------------------------------------------------------


def bronze_suite() -> list[Expectation]:
    """Raw layer: the minimum the Silver projection needs."""
    return [
        not_null("id"),
        not_null("type"),
        not_null("created_at"),
        in_set("type", KNOWN_EVENT_TYPES, mostly=0.95),
    ]


def silver_suite() -> list[Expectation]:
    """Contract layer: key present and unique, hour in range."""
    return [
        not_null("event_id"),
        unique("event_id"),
        not_null("event_type"),
        not_null("created_at"),
        not_null("event_date"),
        between("event_hour", 0, 23),
    ]


def gold_suite() -> list[Expectation]:
    """Event fact: what its joins and its day directories rely on."""
    return [
        not_null("event_id"),
        unique("event_id"),
        not_null("event_date"),
        not_null("event_type"),
    ]


def staging_suite() -> list[Expectation]:
    return [not_null("event_id"), unique("event_id"), not_null("event_type"), not_null("created_at"), not_null("event_date")]


def fact_model_suite() -> list[Expectation]:
    return [
        not_null("event_id"),
        unique("event_id"),
        not_null("event_type"),
        not_null("event_date"),
        relationship("repo_id", "dim_repo", "repo_id", where="repo_id is not null"),
        relationship("actor_id", "dim_actor", "actor_id", where="actor_id is not null"),
    ]


def dim_date_suite() -> list[Expectation]:
    return [not_null("date_key"), unique("date_key"), not_null("year"), not_null("month")]


def dim_repo_suite() -> list[Expectation]:
    return [not_null("repo_id"), unique("repo_id"), not_null("repo_name"), not_null("total_events")]


def dim_actor_suite() -> list[Expectation]:
    return [not_null("actor_id"), unique("actor_id"), not_null("total_events")]


SUITE_BUILDERS: dict[str, Callable[[], list[Expectation]]] = {
    "bronze": bronze_suite,
    "silver": silver_suite,
    "gold": gold_suite,
}

#: Model-level tests of the Gold marts (table name -> suite).
MODEL_SUITES: dict[str, Callable[[], list[Expectation]]] = {
    "stg_events": staging_suite,
    "fact_events": fact_model_suite,
    "dim_date": dim_date_suite,
    "dim_repo": dim_repo_suite,
    "dim_actor": dim_actor_suite,
}


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------


def row_level(e: Expectation) -> tuple[Column, Column]:
    """Evaluated and unexpected rows of a row check, as aggregates."""
    c = F.col(e.column)
    if e.kind == "not_null":
        return F.count(F.lit(1)), F.count_if(c.isNull())
    if e.kind == "in_set":
        return F.count(c), F.count_if(c.isNotNull() & ~c.isin(list(e.value_set)))
    if e.kind == "between":
        bad = (c < F.lit(e.min_value)) | (c > F.lit(e.max_value))
        return F.count(c), F.count_if(c.isNotNull() & bad)
    raise ValueError(f"not a row-level expectation: {e.kind}")


def _result(layer: str, e: Expectation, evaluated: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(e.label).alias("expectation"),
        F.lit(e.column).alias("column"),
        F.lit(float(e.mostly)).alias("mostly"),
        evaluated.cast("bigint").alias("evaluated"),
        unexpected.cast("bigint").alias("unexpected"),
    )


def _unique_result(df: DataFrame, layer: str, e: Expectation) -> DataFrame:
    counts = key_counts(df, e.column)
    return counts.agg(
        _result(
            layer,
            e,
            F.coalesce(F.sum("n_rows"), F.lit(0)),
            F.coalesce(F.sum(F.when(F.col("n_rows") > 1, F.col("n_rows"))), F.lit(0)),
        ).alias("r")
    ).select("r.*")


def _relationship_result(df: DataFrame, layer: str, e: Expectation, parent: DataFrame) -> DataFrame:
    child = df.where(e.where) if e.where else df
    counts = key_counts(child, e.column)
    parent_keys = parent.select(F.col(e.parent_column).alias(e.column)).where(F.col(e.column).isNotNull())
    # anti-join: a parent column with repeated values cannot multiply counts
    orphans = keys_missing_from(counts, parent_keys, e.column)
    both = counts.select(F.col("n_rows").alias("ev"), F.lit(0).cast("bigint").alias("un")).unionByName(
        orphans.select(F.lit(0).cast("bigint").alias("ev"), F.col("n_rows").alias("un"))
    )
    return both.agg(
        _result(layer, e, F.coalesce(F.sum("ev"), F.lit(0)), F.coalesce(F.sum("un"), F.lit(0))).alias("r")
    ).select("r.*")


def evaluate(
    df: DataFrame,
    expectations: Sequence[Expectation],
    layer: str,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One result row per expectation (see module docstring for the passes)."""
    rows = [e for e in expectations if e.kind in ("not_null", "in_set", "between")]
    parts: list[DataFrame] = []
    if rows:
        structs = [_result(layer, e, *row_level(e)) for e in rows]
        parts.append(df.agg(F.array(*structs).alias("rs")).select(F.explode("rs").alias("r")).select("r.*"))
    for e in expectations:
        if e.kind == "unique":
            parts.append(_unique_result(df, layer, e))
        elif e.kind == "relationship":
            if not parents or e.parent not in parents:
                raise ValueError(f"relationship on {e.column!r} needs parent table {e.parent!r}")
            parts.append(_relationship_result(df, layer, e, parents[e.parent]))
        elif e.kind not in ("not_null", "in_set", "between"):
            raise ValueError(f"unknown expectation kind {e.kind!r}")
    if not parts:
        raise ValueError("empty suite")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return judged(out)


def judged(counts: DataFrame) -> DataFrame:
    """Counts of each expectation with its verdict."""
    passed = (F.col("evaluated") == 0) | (
        (F.col("evaluated") - F.col("unexpected")).cast("double") >= F.col("mostly") * F.col("evaluated")
    )
    percent = F.when(F.col("evaluated") > 0, F.col("unexpected") * F.lit(100.0) / F.col("evaluated"))
    return counts.withColumns({"success": passed, "unexpected_percent": percent}).select(*RESULT_COLUMNS)


def summarize(results: DataFrame) -> DataFrame:
    """Per layer: evaluated / successful / unsuccessful expectations and success."""
    return results.groupBy("layer").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        (F.count_if(F.col("success")) * F.lit(100.0) / F.count(F.lit(1))).alias("success_percent"),
        F.bool_and("success").alias("success"),
    )


def layer_results(results: DataFrame) -> DataFrame:
    """One row per layer shaped ``name, success, statistics`` where
    ``statistics`` maps the four counters of :func:`summarize` by name."""
    stats = ("evaluated_expectations", "successful_expectations", "unsuccessful_expectations", "success_percent")
    return summarize(results).select(
        F.col("layer").alias("name"),
        "success",
        F.create_map(*[x for k in stats for x in (F.lit(k), F.col(k).cast("double"))]).alias("statistics"),
    )


#: contract schemas of the layer tables: read with them, no footer is merged
LAYER_SCHEMAS = {"bronze": BRONZE_SCHEMA, "silver": SILVER_SCHEMA, "gold": FACT_SCHEMA}


def run_layers(
    spark: SparkSession,
    tables: Mapping[str, str | DataFrame],
    layers: Iterable[str] | None = None,
    suites: Mapping[str, Callable[[], list[Expectation]]] = SUITE_BUILDERS,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Evaluate the suites of the chosen layers; unknown layers and missing
    tables are skipped. Returns the union of results, or ``None`` when no
    layer ran."""
    chosen = list(layers) if layers else list(suites)
    out: DataFrame | None = None
    for layer in chosen:
        if layer not in suites or layer not in tables:
            continue
        src = tables[layer]
        if isinstance(src, str):
            if not table_exists(spark, src):
                continue
            src = read_table(spark, src, LAYER_SCHEMAS.get(layer))
        res = evaluate(src, suites[layer](), layer, parents)
        out = res if out is None else out.unionByName(res)
    return out


class QualityError(RuntimeError):
    """At least one expectation failed."""


def assert_quality(results: DataFrame | None) -> list[dict]:
    """Raise :class:`QualityError` naming the failed expectations (the result
    set is one row per expectation, so collecting it is bounded). No layer run
    passes."""
    if results is None:
        return []
    rows = [r.asDict() for r in results.collect()]
    failed = [f"{r['layer']}:{r['expectation']}" for r in rows if not r["success"]]
    if failed:
        raise QualityError("quality checks failed: " + ", ".join(failed))
    return rows
