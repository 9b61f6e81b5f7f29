"""Composite jobs: land -> Silver -> Gold -> validation/quality -> churn model.

Every layer is a table written under one lake root (shared storage), so each
step reads what the previous one committed: lineage is cut at every layer,
a lost executor only re-runs tasks of the current step, and a rerun of a day
overwrites just that day's partitions (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlake.operators import churn, day_keys, dim_state, marts, quality, quality_state, silver, validation
from eventlake.schema import (
    ACTIVITY_SCHEMA,
    BRONZE_SCHEMA,
    DIM_ACTOR_SCHEMA,
    DIM_DATE_SCHEMA,
    DIM_REPO_SCHEMA,
    FACT_COLUMNS,
    FACT_SCHEMA,
    SILVER_SCHEMA,
    check_contract,
)
from eventlake.sources import bronze as bronze_src
from eventlake.session import scratch_dir
from eventlake.sources.tables import HIVE_NULL, drop_path, read_table, replace_days, table_exists, touch, write_table


@dataclass(frozen=True)
class LakePaths:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._p("bronze", "events")

    @property
    def ledger(self) -> str:
        return self._p("bronze", "_landed_files")

    @property
    def staging(self) -> str:
        return self._p("bronze", "_staging")

    @property
    def progress(self) -> str:
        return self._p("bronze", "_progress")

    @property
    def silver(self) -> str:
        return self._p("silver", "events")

    @property
    def quarantine(self) -> str:
        return self._p("silver", "_rejects")

    @property
    def silver_keys(self) -> str:
        return self._p("silver", "_keys")

    @property
    def silver_pending(self) -> str:
        return self._p("silver", "_pending_days")

    def gold(self, name: str) -> str:
        return self._p("gold", name)

    def dim_state(self, name: str) -> str:
        return self._p("gold", "_members", name)

    @property
    def quality(self) -> str:
        return self._p("quality", "results")

    def quality_state(self, layer: str) -> str:
        return self._p("quality", "state", layer)

    @property
    def quality_layers(self) -> str:
        return self._p("quality", "layers")

    @property
    def ml_runs(self) -> str:
        return self._p("ml", "runs")

    @property
    def model(self) -> str:
        return self._p("ml", "churn_model")

    def run_model(self, run_id: str) -> str:
        return self._p("ml", "models", run_id)

    @property
    def scores(self) -> str:
        return self._p("ml", "scores")


@dataclass(frozen=True)
class SilverResult:
    """Counts of one run, and the days it wrote (None: all)."""

    input_rows: int
    rejected_rows: int
    written_rows: int
    days: tuple[dt.date, ...] | None = None
    #: values that a cast made NULL, by column
    cast_losses: dict[str, int] = field(default_factory=dict)


def bronze_to_silver(
    spark: SparkSession,
    paths: LakePaths,
    days: Sequence[str | dt.date] | None = None,
    processed_at: dt.datetime | None = None,
    keep_rejects: bool = True,
    dedup: str = "window",
    across_days: bool = True,
) -> SilverResult:
    """Bronze (all or chosen days) -> typed, filtered, deduplicated Silver.

    With ``days`` those partitions of Bronze are read and exactly those of
    Silver replaced (a day without rows any more is removed). Rows that have no
    day are read too: they can only be rejected. Rejected rows go to the
    quarantine table, partitioned by day and replaced in the same way, so a
    rerun leaves the same quarantine.

    ``across_days``: a run of days keeps one row per event over all days that have
    been run (see :mod:`eventlake.operators.day_keys`); days that win or lose an
    event by it are written too, and ``days`` of the result names all of them.
    Without it events are deduplicated within the given days alone.

    ``dedup="window"``: one scan, one shuffle by id, where each task sends at
    most one row per id. ``dedup="exception"``: a narrow first pass finds the
    ids that occur more than once, and only their rows meet in the window; worth
    it when storage reads are cheap, rows are wide and duplicates are rare.
    """
    if dedup not in ("window", "exception"):
        raise ValueError(f"dedup must be 'window' or 'exception', got {dedup!r}")
    table = spark.read.schema(BRONZE_SCHEMA).parquet(paths.bronze)
    change = None
    if days is None:
        day_keys.forget(spark, paths.silver_keys, paths.silver_pending)
    elif across_days:
        of_days = lambda some: silver.project(silver.select_days(table, some)).where(silver.key_present())
        change = day_keys.begin(spark, of_days, paths.silver_keys, paths.silver_pending, paths.silver, silver.parse_days(days))
        days = change.days
    raw = silver.select_days(table, days, undated=True)
    projected = silver.project(raw, processed_at)
    obs = Observation(f"silver_in_{uuid.uuid4().hex[:8]}")
    # the scan that feeds Silver also counts what it loses
    counted = silver.project_with_losses(raw, processed_at).observe(
        obs,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~silver.key_present()).alias("rejected_rows"),
        *[F.count_if(F.array_contains(F.col("_lost.column"), c)).alias(f"lost_{c}") for c in silver.CAST_COLUMNS],
    ).drop("_lost")
    rebalance = _multi_day(days)

    def usable(rows: DataFrame) -> DataFrame:
        rows = rows.where(silver.key_present())
        return rows if change is None else rows.join(change.losers, ["event_id", "event_date"], "left_anti").select(*rows.columns)

    if dedup == "window":
        deduped = silver.deduplicate(usable(counted))
    else:
        dup_path = scratch_dir(spark, "silver-dup-ids")
        silver.duplicate_ids(usable(counted)).write.parquet(dup_path)
        dup_ids = spark.read.parquet(dup_path)
        deduped = silver.deduplicate_by_exception(usable(projected), dup_ids, "event_date" if rebalance else None)
        rebalance = False
    wanted = None if days is None else [d.isoformat() for d in silver.parse_days(days)]
    written = replace_days(spark, silver.to_contract(deduped), paths.silver, wanted, rebalance)
    got = obs.get
    all_days = None if days is None else tuple(silver.parse_days(days))
    result = SilverResult(int(got.get("input_rows", 0)), int(got.get("rejected_rows", 0)), written, all_days, {c: int(got[f"lost_{c}"]) for c in silver.CAST_COLUMNS if got.get(f"lost_{c}")})
    if dedup == "exception":
        drop_path(spark, dup_path)
    if keep_rejects and (result.rejected_rows or table_exists(spark, paths.quarantine)):
        rejected = silver.rejects(raw).withColumn("_rejected_at", _stamp(processed_at))
        replace_days(spark, rejected, paths.quarantine, None if wanted is None else [*wanted, HIVE_NULL])
    if change is not None:
        day_keys.done(spark, paths.silver_pending)
    return result


def _stamp(at: dt.datetime | None) -> Column:
    return F.lit(at).cast("timestamp") if at else F.current_timestamp()


def _concurrently(*jobs: Callable[[], None]) -> None:
    """Run independent Spark jobs from parallel driver threads (the scheduler
    interleaves their tasks); re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for fut in [pool.submit(j) for j in jobs]:
            fut.result()


def _multi_day(days: Sequence[str | dt.date] | None) -> bool:
    """Rebalance before a partitioned write only when the batch spans several
    days: after a key shuffle every task holds rows of every day, so without it
    a backfill writes tasks x days small files; a one-day batch writes one
    file per task either way and skips the extra shuffle."""
    return days is None or len(days) > 1


def read_silver(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Silver with its contract schema: no footer reads to infer it."""
    return read_table(spark, paths.silver, SILVER_SCHEMA)


def build_gold(spark: SparkSession, paths: LakePaths, days: Sequence[str | dt.date] | None = None, incremental: bool = True) -> None:
    """Silver -> fact_events (+ the activity rollup) -> dimensions.

    The fact and the day-grained activity rollup are partitioned by
    ``event_date``; with ``days`` only those partitions are recomputed, and a
    day that lost its rows is removed. ``incremental``: the repository and actor
    dimensions are brought forward from the difference of those days and their
    member tables (see :mod:`eventlake.operators.dim_state`); the first such run
    after a full build makes these from the rollup of all days. Otherwise the
    dimensions are rebuilt from that rollup. A run that failed half way leaves a
    marker, and the next one starts from the rollup.
    """
    stg = marts.stg_events(silver.select_days(read_silver(spark, paths), days))
    wanted = None if days is None else [d.isoformat() for d in silver.parse_days(days)]
    marker = paths.dim_state("_changing")
    tables = [paths.gold("activity"), *(p for n in dim_state.DIMENSIONS for p in (paths.gold(n), paths.dim_state(n)))]
    ready = days is not None and incremental and all(table_exists(spark, t) for t in tables) and not table_exists(spark, marker)
    old = None
    if ready:
        before = silver.select_days(read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA), days)
        if not before.isEmpty():
            old = scratch_dir(spark, "rollup-before")
            before.write.parquet(old)
    touch(spark, marker)
    # Silver files never span two dates, so the fact is a narrow scan -> write
    # (one file per input split, no shuffle). Fact and rollup are independent
    # jobs, as are the three dimensions: each group runs concurrently.
    fact = check_contract(marts.fact_events(stg), FACT_SCHEMA, name="fact_events")
    rollup = check_contract(marts.activity(stg), ACTIVITY_SCHEMA, name="activity")
    _concurrently(
        lambda: replace_days(spark, fact, paths.gold("fact_events"), wanted),
        lambda: replace_days(spark, rollup, paths.gold("activity"), wanted, _multi_day(days)),
    )
    if ready:
        _update_dimensions(spark, paths, days, old)
    else:
        act = read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA)
        dims = {
            "dim_repo": check_contract(marts.dim_repo(act), DIM_REPO_SCHEMA, name="dim_repo"),
            "dim_actor": check_contract(marts.dim_actor(act), DIM_ACTOR_SCHEMA, name="dim_actor"),
            "dim_date": check_contract(marts.dim_date(act), DIM_DATE_SCHEMA, name="dim_date"),
        }
        jobs = [lambda n=n, df=df: write_table(df, paths.gold(n)) for n, df in dims.items()]
        for name, dim in dim_state.DIMENSIONS.items():
            drop_path(spark, paths.dim_state(name))
            if days is not None and incremental:
                state = dim_state.with_bucket(dim_state.members(act, dim))
                jobs.append(lambda s=state, n=name: replace_days(spark, s, paths.dim_state(n), None, True, "bucket"))
        _concurrently(*jobs)
    drop_path(spark, marker)


def _update_dimensions(spark: SparkSession, paths: LakePaths, days: Sequence[str | dt.date], old_path: str | None) -> None:
    """Bring the dimensions forward to the replaced days of the rollup; ``old_path``: what these days held."""
    act = read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA)
    new = silver.select_days(act, days)
    nothing = spark.createDataFrame([], ACTIVITY_SCHEMA)
    old = nothing if old_path is None else read_table(spark, old_path, ACTIVITY_SCHEMA)

    def bring(name: str, dim: dim_state.Dimension) -> None:
        at, merged, table = (scratch_dir(spark, f"{name}-{part}") for part in ("changes", "members", "rows"))
        dim_state.member_changes(new, old, dim).write.parquet(at)
        members = StructType.fromDDL(dim_state.MEMBERS_SCHEMA)
        changes, state = read_table(spark, at, members), read_table(spark, paths.dim_state(name), members)
        entities = new.select(F.col(dim.key).alias("entity")).unionAll(old.select(dim.key)).where("entity is not null")
        buckets = sorted(r.bucket for r in dim_state.with_bucket(entities).select("bucket").distinct().collect())  # BUCKETS at most
        dim_state.merge_members(state.where(F.col("bucket").isin(buckets)), changes).write.parquet(merged)
        after = read_table(spark, merged, members)
        replace_days(spark, after, paths.dim_state(name), [str(b) for b in buckets], True, "bucket")
        rows = dim_state.merge_dimension(read_table(spark, paths.gold(name), dim.schema), after, new, old, None if old_path is None else act, dim)
        rows.write.parquet(table)
        write_table(read_table(spark, table, dim.schema), paths.gold(name))
        for path in (at, merged, table):
            drop_path(spark, path)

    def dates() -> None:
        at = scratch_dir(spark, "dim_date-rows")
        now = read_table(spark, paths.gold("dim_date"), DIM_DATE_SCHEMA)
        kept = now.where(~F.col("date_key").isin(silver.parse_days(days)))
        kept.unionByName(marts.dim_date(new)).write.parquet(at)
        write_table(read_table(spark, at, DIM_DATE_SCHEMA), paths.gold("dim_date"))
        drop_path(spark, at)

    _concurrently(*[lambda n=n, d=d: bring(n, d) for n, d in dim_state.DIMENSIONS.items()], dates)
    if old_path is not None:
        drop_path(spark, old_path)


def gold_tables(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """The Gold tables, read with their contract schemas where they have one."""
    schemas = {
        "fact_events": FACT_SCHEMA,
        "dim_repo": DIM_REPO_SCHEMA,
        "dim_actor": DIM_ACTOR_SCHEMA,
        "dim_date": DIM_DATE_SCHEMA,
    }
    schemas["activity"] = ACTIVITY_SCHEMA
    return {n: read_table(spark, paths.gold(n), sch) for n, sch in schemas.items()}


def validate_gold(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Fact key uniqueness, both foreign keys and date coverage as rows."""
    g = gold_tables(spark, paths)
    return validation.gold_checks(g["fact_events"], g["dim_repo"], g["dim_actor"], g["dim_date"])


def run_quality(
    spark: SparkSession, paths: LakePaths, layers: Sequence[str] | None = None, days: Sequence[str | dt.date] | None = None
) -> DataFrame | None:
    """Results of the layer suites, one row per expectation (None: no layer there).

    With ``days`` only these days are read and merged with what is known of the
    others (see :mod:`eventlake.operators.quality_state`); without, all rows are.
    """
    tables = {"bronze": paths.bronze, "silver": paths.silver, "gold": paths.gold("fact_events")}
    if days is None:
        return quality.run_layers(spark, tables, layers)
    out: DataFrame | None = None
    for layer in [n for n in layers or tables if n in tables and table_exists(spark, tables[n])]:
        rows, suite = read_table(spark, tables[layer], quality.LAYER_SCHEMAS[layer]), quality.SUITE_BUILDERS[layer]()
        quality_state.update(spark, rows, suite, paths.quality_state(layer), days)
        kinds = {e.column: rows.schema[e.column].dataType.simpleString() for e in suite}
        part = quality_state.merged(spark, layer, suite, paths.quality_state(layer), kinds)
        out = part if out is None else out.unionByName(part)
    return out


def check_lake(spark: SparkSession, paths: LakePaths) -> tuple[list[dict], list | None, object]:
    """Gold validation and the layer quality suites, evaluated concurrently.

    Returns the Gold check rows, the quality result rows (``None`` when no
    layer exists) and their schema. Both results are one row per check.
    """
    results = run_quality(spark, paths)
    out: dict = {}

    def gold() -> None:
        out["gold"] = [r.asDict() for r in validate_gold(spark, paths).collect()]

    def layers() -> None:
        out["quality"] = results.collect() if results is not None else None

    _concurrently(gold, layers)
    return out["gold"], out["quality"], (results.schema if results is not None else None)


def run_model_tests(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The declared tests of the Gold models (not-null, unique, relationships)."""
    g = gold_tables(spark, paths)
    g["stg_events"] = marts.stg_events(read_silver(spark, paths))
    parents = {"dim_repo": g["dim_repo"], "dim_actor": g["dim_actor"]}
    out: DataFrame | None = None
    for name, suite in quality.MODEL_SUITES.items():
        res = quality.evaluate(g[name], suite(), name, parents)
        out = res if out is None else out.unionByName(res)
    assert out is not None
    return out


def train_churn(spark: SparkSession, paths: LakePaths, config: churn.ChurnConfig) -> DataFrame:
    """Features from the activity rollup, fit, evaluate, persist model + run."""
    act = read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA)
    features = churn.build_features(act, config)
    model, metrics = churn.train(features, config, spark)
    run_id = uuid.uuid4().hex
    churn.save_model(model, paths.model)
    churn.save_model(model, paths.run_model(run_id))
    churn.save_run(metrics, config, paths.ml_runs, run_id, paths.run_model(run_id))
    return metrics


def score_churn(spark: SparkSession, paths: LakePaths, metric: str = "roc_auc") -> DataFrame:
    """Score every entity with the best recorded run: its model is loaded, its features are rebuilt with
    its parameters; the scores are written with the run's id and returned."""
    run = churn.best_run(spark, paths.ml_runs, metric)
    kinds = {f.name: f.type for f in fields(churn.ChurnConfig)}
    read = {"int": int, "float": float, "str": str, "dt.date": dt.date.fromisoformat}
    config = churn.ChurnConfig(**{k: read[kinds[k]](v) for k, v in run["params"].items() if k in kinds})
    features = churn.build_features(read_table(spark, paths.gold("activity"), ACTIVITY_SCHEMA), config)
    scored = churn.score(churn.load_model(run["model_path"]), features).withColumn("run_id", F.lit(run["run_id"]))
    write_table(scored, paths.scores)
    return spark.read.schema(scored.schema).parquet(paths.scores)


def run(
    spark: SparkSession,
    paths: LakePaths,
    raw_files: Sequence[str] | None = None,
    days: Sequence[str | dt.date] | None = None,
    churn_config: churn.ChurnConfig | None = None,
    fail_on_quality: bool = True,
) -> dict:
    """The whole chain, in order. Returns counts and check results."""
    summary: dict = {}
    if raw_files:
        landed = bronze_src.land(spark, raw_files, paths.bronze, paths.ledger)
        summary["bronze_rows"] = landed.rows
    summary["silver"] = bronze_to_silver(spark, paths, days)
    build_gold(spark, paths, summary["silver"].days)
    checks, rows, schema = check_lake(spark, paths)
    summary["gold_checks"] = checks
    if rows is not None:
        # one row per expectation: evaluated once, kept as a report, then gated
        report = spark.createDataFrame(rows, schema)
        report.withColumn("checked_at", F.current_timestamp()).coalesce(1).write.mode("append").json(paths.quality)
        layers = quality.layer_results(report).withColumn("checked_at", F.current_timestamp())
        layers.coalesce(1).write.mode("append").json(paths.quality_layers)
        summary["quality"] = quality.assert_quality(report) if fail_on_quality else [r.asDict() for r in rows]
    if churn_config is not None:
        summary["churn"] = train_churn(spark, paths, churn_config).first().asDict()
    return summary


def list_raw_files(spark: SparkSession, raw_root: str, pattern: str = "*.json.gz") -> list[str]:
    """Dump files under ``raw_root`` (see :func:`eventlake.sources.bronze.list_raw_files`)."""
    return bronze_src.list_raw_files(spark, raw_root, pattern)


PROGRESS_SCHEMA = "first_day date, last_day date, step string, at timestamp"
#: steps of a batch, in order
STEPS = ("staged", "landed", "silver", "gold")


def _batches(start: dt.date, end: dt.date, batch_days: int | None) -> list[tuple[dt.date, dt.date]]:
    """First and last day of each batch; batches hang on the calendar, not on ``start``, so other ranges meet the same ones."""
    if end < start:
        raise ValueError("end must not be before start")
    if batch_days is None:
        return [(start, end)]
    if batch_days < 1:
        raise ValueError("batch_days must be at least 1")
    out, day = [], start
    while day <= end:
        last = dt.date.fromordinal((day.toordinal() // batch_days + 1) * batch_days - 1)
        out.append((day, min(last, end)))
        day = last + dt.timedelta(days=1)
    return out


def backfill(
    spark: SparkSession,
    paths: LakePaths,
    raw_root: str,
    start: dt.date,
    end: dt.date,
    batch_days: int | None = None,
    after: Callable[[str, dt.date, dt.date], None] | None = None,
) -> dict:
    """Land every not-yet-landed dump of ``start..end`` and rebuild those days
    of Silver and Gold; reports the hours of the range that have no dump file.

    The range is worked off in batches of ``batch_days`` (None: one). A batch is
    staged, moved into Bronze, refined and modelled, and each step is entered in
    a progress table. A run that fails anywhere is resumed by calling again:
    staged dumps are landed as they were staged, no dump twice, and batches whose
    last step is entered are passed over unless new dumps have come for them.
    ``after(step, first_day, last_day)`` is called after each step.
    """
    wanted, hours_without_file = bronze_src.files_for_range(spark, raw_root, start, end)
    out: dict = {"files_found": len(wanted), "hours_without_file": hours_without_file, "bronze_rows": 0, "files_landed": 0, "batches": []}
    finished = _progress(spark, paths)

    def step(name: str, first: dt.date, last: dt.date) -> None:
        row = spark.createDataFrame([(first, last, name)], "first_day date, last_day date, step string")
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(paths.progress)
        if after is not None:
            after(name, first, last)

    def landed(staging: str) -> None:
        rows, files = bronze_src.publish_batch(spark, staging, paths.bronze, paths.ledger)
        out["bronze_rows"] += rows
        out["files_landed"] += len(files)
        finished.difference_update(bronze_src.dump_day(f) for f in files)

    for staging in bronze_src.staged_batches(spark, paths.staging):
        if bronze_src.is_staged(spark, staging):  # staged before a failure: land it first
            landed(staging)
        else:
            drop_path(spark, staging)
    todo = {r.file_path: r.file_name for r in bronze_src.pending_files(spark, wanted, paths.ledger).collect()} if wanted else {}
    for first, last in _batches(start, end, batch_days):
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        files = sorted(p for p, name in todo.items() if first <= bronze_src.dump_day(name) <= last)
        if not files and all(d in finished for d in days):
            continue
        if files:
            staging = f"{paths.staging}/{first.isoformat()}-{last.isoformat()}-{uuid.uuid4().hex[:8]}"
            bronze_src.stage_batch(spark, files, staging)
            step("staged", first, last)
            landed(staging)
            step("landed", first, last)
        if table_exists(spark, paths.bronze):
            out["silver"] = bronze_to_silver(spark, paths, days)
            step("silver", first, last)
            build_gold(spark, paths, out["silver"].days)
            step("gold", first, last)
            out["batches"].append((first, last))
    return out


def _progress(spark: SparkSession, paths: LakePaths) -> set[dt.date]:
    """Days whose last entered step is the last one (a row per batch and step)."""
    if not table_exists(spark, paths.progress):
        return set()
    table = spark.read.schema(PROGRESS_SCHEMA).parquet(paths.progress)
    day = F.explode(F.sequence("first_day", "last_day")).alias("day")
    latest = table.select("step", "at", day).groupBy("day").agg(F.max_by("step", "at").alias("step"))
    return {r.day for r in latest.where(F.col("step") == STEPS[-1]).collect()}


__all__ = [
    "FACT_COLUMNS",
    "LakePaths",
    "SilverResult",
    "backfill",
    "bronze_to_silver",
    "build_gold",
    "check_lake",
    "list_raw_files",
    "run",
    "run_model_tests",
    "run_quality",
    "train_churn",
    "validate_gold",
]
