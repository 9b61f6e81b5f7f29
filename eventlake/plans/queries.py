"""Registered queries over the shared test tables (``events`` and friends).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame computed over
the whole input table; ``__spark_entry__`` exposes them with their DuckDB
oracles. Audit columns stamped with the wall clock are left out of the
compared outputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.columns import hash_bucket
from eventlake.operators import churn, layout, marts, quality, silver, validation
from eventlake.plans import medallion, sql_models
from eventlake.session import scratch_dir
from eventlake.sources import bronze, driver


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver.events_as_silver(driver.load_events(spark, sf_dir))


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_events(_silver(spark, sf_dir))


# --- Silver ---------------------------------------------------------------


def silver_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows -> the 13 typed Silver columns (audit stamp left out)."""
    return _silver(spark, sf_dir).drop("_silver_processed_at")


def silver_normalize_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed ids and timestamps become NULL and the rows are dropped."""
    raw = driver.events_with_bad_rows(driver.load_events(spark, sf_dir))
    return silver.normalize(raw).drop("_silver_processed_at")


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows normalisation drops, with the reason (quarantine)."""
    raw = driver.events_with_bad_rows(driver.load_events(spark, sf_dir))
    return silver.rejects(raw)


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dump landed twice; the copy ingested last survives."""
    bronze = driver.events_replayed(driver.load_events(spark, sf_dir))
    return silver.deduplicate(silver.normalize(bronze)).drop("_silver_processed_at")


def silver_incremental_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the chosen days are read (partition pruning on Bronze)."""
    bronze = driver.events_as_raw(driver.load_events(spark, sf_dir))
    days = silver.select_days(bronze, ["2024-01-03", "2024-01-04"])
    return silver.deduplicate(silver.normalize(days)).drop("_silver_processed_at")


# --- Gold marts -----------------------------------------------------------


def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging projection of Silver."""
    return _stg(spark, sf_dir)


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event-grain fact."""
    return marts.fact_events(_stg(spark, sf_dir))


def dim_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: repository dimension straight from the events."""
    return marts.dim_repo(_stg(spark, sf_dir))


def dim_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actor dimension straight from the events."""
    return marts.dim_actor(_stg(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date dimension of the observed days."""
    return marts.dim_date(_stg(spark, sf_dir))


def dim_repo_from_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 from the (repo, actor, day, type) rollup."""
    return marts.dim_repo(marts.activity(_stg(spark, sf_dir)))


def dim_actor_from_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 from the rollup."""
    return marts.dim_actor(marts.activity(_stg(spark, sf_dir)))


def dim_date_from_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 from the rollup."""
    return marts.dim_date(marts.activity(_stg(spark, sf_dir)))


def top_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten most active repositories."""
    return marts.top_repos(marts.dim_repo(_stg(spark, sf_dir)), 10)


# --- Gold validation --------------------------------------------------------

STALE_DIM_CUTOFF = "2024-01-02"  # dimension snapshot taken after the first day
DIM_DATE_CUTOFF = "2024-01-15"


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact_events(_stg(spark, sf_dir))


def fact_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows vs distinct event ids of the fact."""
    return validation.key_uniqueness(_fact(spark, sf_dir), "event_id")


def orphans_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose repository is missing from the dimension (count)."""
    stg = _stg(spark, sf_dir)
    return validation.orphan_summary(marts.fact_events(stg), marts.dim_repo(stg), "repo_id")


def orphans_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose actor is missing from the dimension (count)."""
    stg = _stg(spark, sf_dir)
    return validation.orphan_summary(marts.fact_events(stg), marts.dim_actor(stg), "actor_id")


def orphans_actor_stale_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact vs an actor dimension built before ``STALE_DIM_CUTOFF``: the
    actors first seen later are the orphans, with their fact row counts."""
    stg = _stg(spark, sf_dir)
    snapshot = marts.dim_actor(stg.where(F.col("event_date") < F.lit(STALE_DIM_CUTOFF).cast("date")))
    return validation.orphan_keys(marts.fact_events(stg), snapshot, "actor_id")


def orphan_rows_actor_stale_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orphan fact rows themselves (``LEFT JOIN ... IS NULL`` form)."""
    stg = _stg(spark, sf_dir)
    snapshot = marts.dim_actor(stg.where(F.col("event_date") < F.lit(STALE_DIM_CUTOFF).cast("date")))
    fact = marts.fact_events(stg)
    return validation.orphan_rows(fact, snapshot, "actor_id").select("event_id", "actor_id", "repo_id")


def date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact dates missing from the date dimension."""
    stg = _stg(spark, sf_dir)
    return validation.date_gaps(marts.fact_events(stg), marts.dim_date(stg))


def date_gaps_stale_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 against a date dimension built before the middle of the month."""
    stg = _stg(spark, sf_dir)
    dates = marts.dim_date(stg.where(F.col("event_date") < F.lit(DIM_DATE_CUTOFF).cast("date")))
    return validation.date_gaps(marts.fact_events(stg), dates)


def gold_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All Gold validation checks as rows."""
    stg = _stg(spark, sf_dir)
    return validation.gold_checks(marts.fact_events(stg), marts.dim_repo(stg), marts.dim_actor(stg), marts.dim_date(stg))


# --- Quality suites ---------------------------------------------------------


def quality_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1/Q3/Q7: Bronze suite over the raw-shaped events."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    return quality.evaluate(raw, quality.bronze_suite(), "bronze")


def quality_bronze_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze suite on raw rows whose type was left unmapped (not in the known
    set) and whose ids/timestamps are partly broken."""
    raw = driver.events_with_bad_rows(driver.load_events(spark, sf_dir))
    raw = raw.withColumn("type", F.when(F.col("type") == "ForkEvent", F.lit("click")).otherwise(F.col("type")))
    raw = raw.withColumn("created_at", F.when(F.col("created_at") == "not-a-timestamp", F.lit(None)).otherwise(F.col("created_at")))
    return quality.evaluate(raw, quality.bronze_suite(), "bronze")


def quality_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1/Q2/Q4/Q7: Silver suite."""
    return quality.evaluate(_silver(spark, sf_dir), quality.silver_suite(), "silver")


def quality_silver_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver suite on replayed rows before dedup: uniqueness must fail."""
    rows = silver.normalize(driver.events_replayed(driver.load_events(spark, sf_dir)))
    return quality.evaluate(rows, quality.silver_suite(), "silver")


def quality_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1/Q2/Q7: Gold fact suite."""
    return quality.evaluate(_fact(spark, sf_dir), quality.gold_suite(), "gold")


def quality_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1/Q2/Q5: the declared tests of every Gold model, relationships included."""
    stg = _stg(spark, sf_dir)
    tables = {
        "stg_events": stg,
        "fact_events": marts.fact_events(stg),
        "dim_date": marts.dim_date(stg),
        "dim_repo": marts.dim_repo(stg),
        "dim_actor": marts.dim_actor(stg),
    }
    parents = {"dim_repo": tables["dim_repo"], "dim_actor": tables["dim_actor"]}
    out = None
    for name, suite in quality.MODEL_SUITES.items():
        res = quality.evaluate(tables[name], suite(), name, parents)
        out = res if out is None else out.unionByName(res)
    return out


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7/Q8: per-layer roll-up of the three layer suites."""
    events = driver.load_events(spark, sf_dir)
    raw = driver.events_as_raw(events)
    slv = silver.normalize(raw)
    tables = {"bronze": raw, "silver": slv, "gold": marts.fact_events(marts.stg_events(slv))}
    return quality.summarize(quality.run_layers(spark, tables))


# --- Churn ------------------------------------------------------------------

CHURN_SPLIT = dt.date(2024, 1, 30)


def _actor_config() -> churn.ChurnConfig:
    return churn.ChurnConfig(split_date=CHURN_SPLIT, min_events_in_train=5, entity="actor_id", distinct_col="repo_id")


def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3: churn features per actor (split 2024-01-30, at least 5 train events)."""
    return churn.build_features(_fact(spark, sf_dir), _actor_config())


def churn_features_from_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3 computed from the activity rollup."""
    return churn.build_features(marts.activity(_stg(spark, sf_dir)), _actor_config())


def churn_features_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M3 with the default entity (repository), split 2024-01-16."""
    cfg = churn.ChurnConfig(split_date=dt.date(2024, 1, 16), min_events_in_train=5)
    return churn.build_features(_fact(spark, sf_dir), cfg)


def churn_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: total, churned and churn rate of the feature table."""
    return churn.churn_rate(churn_features(spark, sf_dir))


def churn_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: sizes of the md5 hash split."""
    train_df, test_df = churn.split(churn_features(spark, sf_dir), _actor_config())
    return train_df.select(F.lit("train").alias("part"), "actor_id").unionByName(
        test_df.select(F.lit("test").alias("part"), "actor_id")
    ).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def churn_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities, churned, and both sides of the hash split with the
    test side's churned count -- the deterministic part of the model run."""
    cfg = _actor_config()
    feats = churn_features(spark, sf_dir)
    test = F.col("_bucket") >= F.lit(cfg.train_fraction)
    return feats.withColumn("_bucket", hash_bucket([cfg.entity], cfg.seed)).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("churned") == 1).alias("churned"),
        F.count_if(~test).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        F.count_if(test & (F.col("churned") == 1)).alias("test_churned"),
    )


def churn_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit and evaluate the model (no SQL form)."""
    _, metrics = churn.train(churn_features(spark, sf_dir), _actor_config(), spark)
    return metrics


# --- Layout -----------------------------------------------------------------

LOOKUP_DATE = "2024-01-15"
LOOKUP_KEY = 42


def _written(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    path = scratch_dir(spark, f"layout-{how}")
    df = _fact(spark, sf_dir)
    if how == "partitioned":
        layout.write_partitioned(df, path, ("event_date",))
    elif how == "clustered":
        layout.write_clustered(df, path, ["repo_id"], n_files=8)
    elif how == "zordered":
        layout.write_clustered(df, path, ["repo_id", "actor_id"], n_files=8)
    else:
        layout.write_flat(df, path)
    return spark.read.parquet(path)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_events"))


def pruned_partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1/P10: count of one day on the date-partitioned copy."""
    t = _written(spark, sf_dir, "partitioned")
    return _count(t.where(F.col("event_date") == F.lit(LOOKUP_DATE).cast("date")))


def flat_date_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the same count on the unpartitioned copy."""
    t = _written(spark, sf_dir, "flat")
    return _count(t.where(F.col("event_date") == F.lit(LOOKUP_DATE).cast("date")))


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup on the copy clustered by repository."""
    t = _written(spark, sf_dir, "clustered")
    return _count(t.where(F.col("repo_id") == F.lit(LOOKUP_KEY)))


def zordered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: lookup on the second key of a two-column Z-ordered copy."""
    t = _written(spark, sf_dir, "zordered")
    return _count(t.where(F.col("actor_id") == F.lit(LOOKUP_KEY)))


def _join(spark: SparkSession, sf_dir: str, strategy: str, **kw) -> DataFrame:
    stg = _stg(spark, sf_dir)
    fact, repos = marts.fact_events(stg), marts.dim_repo(stg)
    dim = repos.select("repo_id", "repo_name", "total_events")
    return layout.join_dim(fact, dim, "repo_id", strategy=strategy, **kw).select(
        "event_id", "repo_id", "repo_name", "total_events"
    )


def join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact x repository dimension, broadcast after the size check."""
    return _join(spark, sf_dir, "broadcast")


def join_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as a sort-merge join."""
    return _join(spark, sf_dir, "shuffle")


def join_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join, strategy left to Catalyst/AQE."""
    return _join(spark, sf_dir, "auto")


# --- Bronze landing and coverage ---------------------------------------------


def hour_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of the observed days with its event count (0 = missing)."""
    slv = _silver(spark, sf_dir)
    return bronze.hour_coverage(bronze.observed_hour_grid(slv), slv)


def daily_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours present / missing and events per day."""
    cov = hour_coverage(spark, sf_dir)
    return cov.groupBy("event_date").agg(
        F.count_if(~F.col("missing")).alias("hours_present"),
        F.count_if(F.col("missing")).alias("hours_missing"),
        F.sum("n_events").cast("bigint").alias("n_events"),
    )


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Write the events as gzipped JSON-lines dumps, land them into Bronze."""
    raw_dir = scratch_dir(spark, "raw-dumps")
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir)).drop("event_date", "_ingested_at")
    raw.write.option("compression", "gzip").json(raw_dir)
    files = medallion.list_raw_files(spark, raw_dir)
    bronze_path = scratch_dir(spark, "bronze")
    bronze.land(spark, files, bronze_path, ingested_at=dt.datetime(2024, 2, 1))
    return bronze.read_bronze(spark, bronze_path), bronze_path


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as gzip dumps, landed, Bronze read back."""
    b, _ = _landed(spark, sf_dir)
    return b.select(
        "id",
        "type",
        F.col("actor.id").try_cast("bigint").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").try_cast("bigint").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        F.col("payload"),
        F.col("public").try_cast("boolean").alias("public"),
        "created_at",
        "event_date",
    )


def silver_from_landed_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps -> Bronze -> Silver table through the composite jobs, read back."""
    root = scratch_dir(spark, "lake")
    paths = medallion.LakePaths(root)
    raw_dir = scratch_dir(spark, "raw-dumps")
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir)).drop("event_date", "_ingested_at")
    raw.write.option("compression", "gzip").json(raw_dir)
    bronze.land(spark, medallion.list_raw_files(spark, raw_dir), paths.bronze, paths.ledger)
    medallion.bronze_to_silver(spark, paths)
    return medallion.read_silver(spark, paths).drop("_ingested_at", "_silver_processed_at")


def gold_dim_repo_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver -> Gold tables through the composite job; dim_repo read back."""
    root = scratch_dir(spark, "lake")
    paths = medallion.LakePaths(root)
    silver.write_silver(_silver(spark, sf_dir), paths.silver, dynamic=False)
    medallion.build_gold(spark, paths)
    return spark.read.parquet(paths.gold("dim_repo"))


# --- SQL models over temp views ----------------------------------------------


def _views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return sql_models.create_views(spark, _silver(spark, sf_dir))


def sql_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a SQL view."""
    return _views(spark, sf_dir)["fact_events"]


def sql_dim_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repository dimension as a SQL view."""
    return _views(spark, sf_dir)["dim_repo"]


def sql_dim_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actor dimension as a SQL view."""
    return _views(spark, sf_dir)["dim_actor"]


def sql_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension as a SQL view."""
    return _views(spark, sf_dir)["dim_date"]


def sql_top_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 over the SQL views."""
    _views(spark, sf_dir)
    return sql_models.validate(spark, "top_repos")


def sql_fact_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8/Q10 over the SQL views."""
    _views(spark, sf_dir)
    return sql_models.validate(spark, "fact_uniqueness")


def sql_orphans_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8/J4 over the SQL views (repository)."""
    _views(spark, sf_dir)
    return sql_models.validate(spark, "orphans_repo")


def sql_orphans_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8/J4 over the SQL views (actor)."""
    _views(spark, sf_dir)
    return sql_models.validate(spark, "orphans_actor")


def sql_date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8/J6 over the SQL views."""
    _views(spark, sf_dir)
    return sql_models.validate(spark, "date_coverage")


# --- mart options -------------------------------------------------------------


def dim_repo_latest_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 option: display name = the name seen last."""
    return marts.dim_repo(_stg(spark, sf_dir), name_rule="latest")


def join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salted shuffle join (every key salted)."""
    return _join(spark, sf_dir, "salted")


#: a key is hot if it alone holds what one of 200 partitions holds on average
HOT_SHARE = 0.005


def join_salted_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salting restricted to the hot repositories (threshold relative to the
    table size, so it scales with the input)."""
    return _join(spark, sf_dir, "salted", hot_share=HOT_SHARE)


# --- Streaming form -----------------------------------------------------------


def streaming_silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze streamed to Silver in two runs, the second bringing a replay of
    every event (most of them weeks late): the days are merged, nothing is lost
    and every event stands once."""
    from eventlake.streaming import landing

    paths, ckpt = medallion.LakePaths(scratch_dir(spark, "stream-lake")), scratch_dir(spark, "stream-ckpt")
    events = driver.load_events(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    landing_order = (events.where(odd), events.unionByName(events.where(~odd)))
    for part in landing_order:
        driver.as_bronze(driver.events_as_raw(part)).write.mode("append").partitionBy("event_date").parquet(paths.bronze)
        landing.bronze_stream_to_silver(spark, paths, ckpt).awaitTermination()
    return medallion.read_silver(spark, paths).drop("_ingested_at", "_silver_processed_at")


def silver_rerun_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps -> Bronze -> full Silver build, then a rerun of two days
    (dynamic partition overwrite): the table read back must equal a single
    build -- nothing duplicated, no other day touched."""
    root = scratch_dir(spark, "lake-rerun")
    paths = medallion.LakePaths(root)
    raw_dir = scratch_dir(spark, "raw-dumps")
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir)).drop("event_date", "_ingested_at")
    raw.write.option("compression", "gzip").json(raw_dir)
    bronze.land(spark, medallion.list_raw_files(spark, raw_dir), paths.bronze, paths.ledger)
    medallion.bronze_to_silver(spark, paths)
    medallion.bronze_to_silver(spark, paths, days=["2024-01-10", "2024-01-11"])
    return medallion.read_silver(spark, paths).drop("_ingested_at", "_silver_processed_at")


def gold_incremental_dim_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full Gold build, then an incremental rebuild of two days (fact and
    rollup partitions replaced, dimensions re-derived from the rollup): the
    actor dimension read back must equal the one of a single full build."""
    root = scratch_dir(spark, "lake-gold-incr")
    paths = medallion.LakePaths(root)
    silver.write_silver(_silver(spark, sf_dir), paths.silver, dynamic=False)
    medallion.build_gold(spark, paths)
    medallion.build_gold(spark, paths, days=["2024-01-20", "2024-01-21"])
    return spark.read.parquet(paths.gold("dim_actor"))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per expectation of the three layer suites (Bronze, Silver,
    Gold) over the mapped test events."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    slv = silver.normalize(raw)
    tables = {"bronze": raw, "silver": slv, "gold": marts.fact_events(marts.stg_events(slv))}
    return quality.run_layers(spark, tables)


def silver_dedup_by_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dedup of ``silver_dedup`` through the narrow duplicate-id pass:
    unique ids pass without a shuffle, only duplicated ids meet in the window."""
    events = driver.load_events(spark, sf_dir)
    late = driver.events_as_raw(events.where("event_id % 10 = 3"), ingest_delay="INTERVAL 1 DAY")  # 10% replays
    rows = silver.normalize(driver.events_as_raw(events).unionByName(late))
    dup_path = scratch_dir(spark, "dup-ids")
    silver.duplicate_ids(rows).write.parquet(dup_path)
    return silver.deduplicate_by_exception(rows, spark.read.parquet(dup_path)).drop("_silver_processed_at")


def month_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the calendar month of the data (January 2024, 744 hours)
    that no event falls into, with their expected dump file names."""
    slv = _silver(spark, sf_dir)
    grid = bronze.month_grid(spark, 2024, 1)
    seen = bronze.hourly_counts(slv).select("hour_start")
    return grid.join(seen, "hour_start", "left_anti").select("hour_start", "event_date", "hour", "file_name")


def optimized_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the fact written plainly, rewritten by ``optimize_table`` (file
    count from its on-disk size) clustered by repository, then a point lookup."""
    src, dst = scratch_dir(spark, "opt-src"), scratch_dir(spark, "opt-dst")
    layout.write_flat(_fact(spark, sf_dir), src)
    layout.optimize_table(spark, src, dst, ["repo_id"], target_file_bytes=64 * 1024)
    return _count(spark.read.parquet(dst).where(F.col("repo_id") == F.lit(LOOKUP_KEY)))


def hot_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot-key detection used by the salted join: repositories holding at
    least ``HOT_SHARE`` of all events."""
    return layout.hot_keys(_fact(spark, sf_dir), "repo_id", HOT_SHARE)


# --- landing, reruns and built tables -------------------------------------------


def _lake_of_lines(spark: SparkSession, lines: DataFrame) -> medallion.LakePaths:
    """A lake whose Bronze was landed from gzip dumps of these lines."""
    raw_dir, paths = scratch_dir(spark, "raw-lines"), medallion.LakePaths(scratch_dir(spark, "lake"))
    lines.write.option("compression", "gzip").text(raw_dir)
    bronze.land(spark, medallion.list_raw_files(spark, raw_dir, "*.gz"), paths.bronze, paths.ledger, ingested_at=dt.datetime(2024, 2, 1))
    return paths


def bronze_string_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the dumps write ids and flags as strings; all events keep theirs."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    paths = _lake_of_lines(spark, driver.dump_lines(raw, text_ids=F.col("id").cast("bigint") % 2 == 0))
    return silver.normalize(bronze.read_bronze(spark, paths.bronze)).drop("_ingested_at", "_silver_processed_at")


def bronze_schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member that only some dumps have survives landing."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    org = F.when(F.col("id").cast("bigint") % 3 == 0, F.struct(F.concat(F.lit("org"), F.col("actor.id")).alias("login")))
    paths = _lake_of_lines(spark, driver.dump_lines(raw, {"org": org}))
    b = bronze.with_members(bronze.read_bronze(spark, paths.bronze), {"org_login": ("org", "$.login", "string")})
    return b.select(F.col("id").cast("bigint").alias("event_id"), "org_login", F.col("actor.display_login").alias("display_login"))


def payload_struct_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dumps with nested payloads read through schema inference; Silver serialises them."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir)).withColumn("payload", F.from_json("payload", "k bigint"))
    raw_dir = scratch_dir(spark, "raw-struct")
    driver.dump_lines(raw).write.option("compression", "gzip").text(raw_dir)
    files = medallion.list_raw_files(spark, raw_dir, "*.gz")
    rows = silver.normalize(bronze.with_ingest_columns(bronze.read_events(spark, files, infer=True)))
    return rows.select("event_id", F.replace("payload_json", F.lit(" "), F.lit("")).alias("payload_json"))


def quarantine_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows landed, Silver built in runs of some days, all of them
    twice: every event is either in Silver or once in quarantine."""
    raw = driver.events_with_bad_rows(driver.load_events(spark, sf_dir))
    paths = _lake_of_lines(spark, driver.dump_lines(raw))
    start = dt.date(2024, 1, 1)
    runs = [[start + dt.timedelta(days=i) for i in range(a, b)] for a, b in ((0, 12), (12, 40))]
    for days in (*runs, *runs):
        medallion.bronze_to_silver(spark, paths, days)
    good = medallion.read_silver(spark, paths).select(F.lit("silver").alias("place"), F.col("event_id").cast("string").alias("id"), F.lit(None).cast("string").alias("reason"))
    return good.unionAll(spark.read.parquet(paths.quarantine).select(F.lit("quarantine"), "raw_id", "reason"))


def silver_rerun_vanished_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that Bronze no longer has is gone from Silver, fact and rollup after its rerun."""
    from eventlake.sources.tables import drop_partitions

    paths = medallion.LakePaths(scratch_dir(spark, "lake-vanished"))
    driver.as_bronze(driver.events_as_raw(driver.load_events(spark, sf_dir))).write.partitionBy("event_date").parquet(paths.bronze)
    medallion.bronze_to_silver(spark, paths)
    medallion.build_gold(spark, paths)
    gone = "2024-01-10"
    drop_partitions(spark, paths.bronze, "event_date", [gone])
    for days in ([gone], [gone, "2024-01-11"]):
        medallion.bronze_to_silver(spark, paths, days)
        medallion.build_gold(spark, paths, days)
    tables = {"silver": medallion.read_silver(spark, paths)} | {k: v for k, v in medallion.gold_tables(spark, paths).items() if k in ("fact_events", "activity")}
    counts = [t.select(F.lit(k).alias("table"), "event_date", (F.col("n_events") if k == "activity" else F.lit(1)).alias("n")) for k, t in tables.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).groupBy("table", "event_date").agg(F.sum("n").cast("bigint").alias("n_events"))


def fact_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned fact table as the composite job writes it."""
    paths = medallion.LakePaths(scratch_dir(spark, "lake-fact"))
    silver.write_silver(_silver(spark, sf_dir), paths.silver, dynamic=False)
    medallion.build_gold(spark, paths)
    return medallion.gold_tables(spark, paths)["fact_events"]


def ledger_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps landed again are skipped, dumps that came meanwhile are landed."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    dirs = [scratch_dir(spark, f"raw-{k}") for k in range(2)]
    for k, d in enumerate(dirs):
        driver.dump_lines(raw.where(F.col("id").cast("bigint") % 2 == k)).write.option("compression", "gzip").text(d)
    files = [medallion.list_raw_files(spark, d, "*.gz") for d in dirs]
    paths = medallion.LakePaths(scratch_dir(spark, "lake-ledger"))
    rows = [bronze.land(spark, some, paths.bronze, paths.ledger).rows for some in (files[0], files[0], files[0] + files[1])]
    n = F.count(F.lit(1))
    return bronze.read_bronze(spark, paths.bronze).agg(*[F.lit(r).cast("bigint").alias(f"landed_{i}") for i, r in enumerate(rows)], n.alias("bronze_rows"))


def orphans_repo_stale_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows whose repository is missing from the dimension (every seventh is)."""
    stg = _stg(spark, sf_dir)
    return validation.orphan_keys(marts.fact_events(stg), marts.dim_repo(stg).where("repo_id % 7 <> 0"), "repo_id")


def sql_orphans_stale_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 over SQL views whose dimensions lack rows: repositories, actors and dates."""
    views = _views(spark, sf_dir)
    for name, rows in (("dim_repo", "repo_id % 7 <> 0"), ("dim_actor", "actor_id % 5 <> 0"), ("dim_date", "day(date_key) <> 3")):
        views[name].where(rows).createOrReplaceTempView(name)
    checks = [sql_models.validate(spark, k).select(F.lit(k).alias("check"), F.col("n").cast("bigint").alias("n")) for k in ("orphans_repo", "orphans_actor", "date_coverage")]
    return checks[0].unionAll(checks[1]).unionAll(checks[2])


def hour_coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage where two hours of every day bring no events."""
    slv = _silver(spark, sf_dir).where("event_hour not in (5, 17)")
    return bronze.hour_coverage(bronze.observed_hour_grid(slv), slv)


def dim_repo_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: repositories renamed half way through the month, and events without a repository."""
    stg = _stg(spark, sf_dir)
    renamed = F.when(F.dayofmonth("event_date") > 15, F.concat(F.lit("a-"), "repo_name")).otherwise(F.col("repo_name"))
    stg = stg.withColumn("repo_name", renamed).withColumn("repo_id", F.when(F.col("event_id") % 11 != 0, F.col("repo_id")))
    latest = marts.latest_name(stg, "repo_id", "repo_name").withColumnRenamed("repo_name", "latest_name")
    return marts.dim_repo(stg).join(latest, "repo_id").select("repo_id", "repo_name", "latest_name", "total_events", "unique_actors")


def churn_fixed_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8/M9: the evaluators of the training job on a fixed score (1 / (1 + days active))."""
    scored = churn_features(spark, sf_dir).select(F.col("churned").cast("double").alias("churned"), (F.lit(1.0) / (1 + F.col("days_active"))).alias("score"))
    scored = scored.withColumn("prediction", (F.col("score") > 0.2).cast("double"))
    accuracy, auc = churn.evaluate(scored.withColumnRenamed("score", "rawPrediction"))
    return spark.range(1).select(F.round(F.lit(accuracy).cast("double"), 9).alias("accuracy"), F.round(F.lit(auc).cast("double"), 9).alias("roc_auc"))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain from dumps to gate; the written report read back."""
    raw_dir, paths = scratch_dir(spark, "raw-run"), medallion.LakePaths(scratch_dir(spark, "lake-run"))
    driver.dump_lines(driver.events_as_raw(driver.load_events(spark, sf_dir))).write.option("compression", "gzip").text(raw_dir)
    medallion.run(spark, paths, medallion.list_raw_files(spark, raw_dir, "*.gz"))
    return spark.read.json(paths.quality).select("layer", "expectation", "column", "mostly", "evaluated", "unexpected", "success")


# --- one row per event across daily runs ------------------------------------------


def _replayed_on_other_days(spark: SparkSession, sf_dir: str) -> medallion.LakePaths:
    """Bronze where every fifth event came again later, dated three days on, and every seventh
    has an older copy dated two days before."""
    events = driver.load_events(spark, sf_dir)

    def copy(every: int, shift: str, delay: str) -> DataFrame:
        created = F.date_format(F.col("ts") + F.expr(shift), driver.ISO_FORMAT)
        return driver.events_as_raw(events.where(F.col("event_id") % every == 0), created_col=created, ingest_delay=delay)

    raw = driver.events_as_raw(events).unionByName(copy(5, "INTERVAL 3 DAYS", "INTERVAL 10 DAYS"))
    raw = raw.unionByName(copy(7, "INTERVAL -2 DAYS", "INTERVAL -1 DAYS"))
    paths = medallion.LakePaths(scratch_dir(spark, "lake-days"))
    driver.as_bronze(raw).hint("rebalance", "event_date").write.partitionBy("event_date").parquet(paths.bronze)
    return paths


def _run_spans(spark: SparkSession, paths: medallion.LakePaths, spans: list[tuple[int, int]]) -> None:
    """Silver runs of the days first..last (excluded) of January 2024, one run per span."""
    for a, b in spans:
        medallion.bronze_to_silver(spark, paths, [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(a, b)])


def silver_cross_day_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of some days, the later ones first and one again: one row per event, the newest."""
    paths = _replayed_on_other_days(spark, sf_dir)
    _run_spans(spark, paths, [(14, 40), (-4, 14), (8, 9)])
    return medallion.read_silver(spark, paths).drop("_silver_processed_at")


def silver_cross_day_vanished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build, then a day that Bronze has lost runs again: events it had won come back to their other day."""
    from eventlake.sources.tables import drop_partitions

    paths = _replayed_on_other_days(spark, sf_dir)
    medallion.bronze_to_silver(spark, paths)
    _run_spans(spark, paths, [(20, 22)])
    drop_partitions(spark, paths.bronze, "event_date", ["2024-01-10"])
    _run_spans(spark, paths, [(9, 10)])
    return medallion.read_silver(spark, paths).drop("_silver_processed_at")


def _gold_brought_forward(spark: SparkSession, sf_dir: str) -> medallion.LakePaths:
    """Gold of the first ten days as a whole, two more spans of days, then two days again that have
    lost and renamed rows: the last two runs bring the dimensions forward."""
    paths = medallion.LakePaths(scratch_dir(spark, "lake-forward"))
    slv = _silver(spark, sf_dir).withColumn("repo_id", F.when(F.col("event_id") % 11 != 0, F.col("repo_id")))

    def put(rows: DataFrame, a: int, b: int) -> list[dt.date]:
        days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(a, b)]
        silver.write_silver(rows.where(F.col("event_date").isin(days)), paths.silver)
        return days

    put(slv, 0, 10)
    medallion.build_gold(spark, paths)
    for span in ((10, 20), (20, 40)):
        medallion.build_gold(spark, paths, put(slv, *span))
    less = slv.where("event_id % 3 <> 1 and event_hour < 20").withColumn("repo_name", F.concat(F.lit("z-"), "repo_name"))
    medallion.build_gold(spark, paths, put(less, 4, 6))
    return paths


def gold_forward_dim_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2/C4: the repository dimension brought forward over spans of days and a rerun."""
    return medallion.gold_tables(spark, _gold_brought_forward(spark, sf_dir))["dim_repo"]


def gold_forward_dim_actor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actor dimension of the same runs."""
    return medallion.gold_tables(spark, _gold_brought_forward(spark, sf_dir))["dim_actor"]


# --- members beyond the envelope ---------------------------------------------------


def _grown_dumps(spark: SparkSession, sf_dir: str) -> medallion.LakePaths:
    """Dumps that bring an organisation from the tenth on, a score from the twentieth on (a fraction for odd ids),
    and a site of some actors."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    number, day = F.col("id").cast("bigint"), F.dayofmonth("event_date")
    org = F.when(day >= 10, F.struct(F.concat(F.lit("org"), F.col("actor.id")).alias("login"), (number % 7).alias("id")))
    score = F.when((day >= 20) & (number % 3 == 0), F.when(number % 2 == 0, F.to_json(F.struct((number % 50).alias("v")))).otherwise(F.to_json(F.struct(((number % 50) + F.lit(0.5)).alias("v")))))
    site = F.when(number % 5 == 0, F.concat(F.lit("https://example.invalid/"), F.col("actor.id")))
    raw = raw.withColumn("actor", F.col("actor").withField("site", site))
    lines = driver.dump_lines(raw, {"org": org, "score": F.parse_json(score)})
    return _lake_of_lines(spark, lines)


def bronze_new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that dumps have gained, with type, first day and number of records."""
    return bronze.new_members(bronze.read_bronze(spark, _grown_dumps(spark, sf_dir).bronze))


def bronze_member_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same members as typed columns beside the envelope."""
    typed = {"org_id": ("org", "$.id", "bigint"), "org_login": ("org", "$.login", "string"), "score": ("score", "$.v", "double"), "site": ("actor", "$.site", "string")}
    b = bronze.with_members(bronze.read_bronze(spark, _grown_dumps(spark, sf_dir).bronze), typed)
    return b.select(F.col("id").cast("bigint").alias("event_id"), *typed)


# --- quality day by day -------------------------------------------------------------


def quality_merged_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suites merged from three runs of days and one day run again; bad rows, replays on the
    same and on other days, rows without a day."""
    paths = medallion.LakePaths(scratch_dir(spark, "lake-quality"))
    raw = driver.as_bronze(driver.events_with_bad_rows(driver.load_events(spark, sf_dir)))
    raw.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(paths.bronze)
    slv = _silver(spark, sf_dir)
    later = slv.where("event_id % 13 = 0").withColumn("event_date", F.date_add("event_date", 2))
    slv = slv.unionByName(later).unionByName(slv.where("event_id % 17 = 0"))
    less = slv.where("event_id % 2 = 0 or event_date <> date'2024-01-05'")

    def put(rows: DataFrame, a: int, b: int) -> list[dt.date]:
        days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(a, b)]
        silver.write_silver(rows.where(F.col("event_date").isin(days)), paths.silver)
        return days

    for rows, a, b in ((slv, 0, 10), (slv, 10, 20), (slv, 20, 40), (less, 4, 5)):
        report = medallion.run_quality(spark, paths, ["bronze", "silver"], put(rows, a, b))
    return report


# --- resumed backfill -----------------------------------------------------------------


def _hourly_dumps(spark: SparkSession, sf_dir: str) -> str:
    """A folder with gzipped dumps named as dumps are; each holds the events of six hours."""
    raw = driver.events_as_raw(driver.load_events(spark, sf_dir))
    hour = (F.floor(F.hour(F.try_to_timestamp("created_at")) / 6) * 6).cast("string")
    named = driver.dump_lines(raw, {"dump": F.concat(F.date_format("event_date", "yyyy-MM-dd"), F.lit("-"), hour)})
    named = named.withColumn("dump", F.get_json_object("value", "$.dump"))
    parts, root = scratch_dir(spark, "dump-parts"), scratch_dir(spark, "dumps")
    named.repartition("dump").write.partitionBy("dump").option("compression", "gzip").text(parts)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(root))
    for f in fs.globStatus(hadoop.Path(f"{parts}/dump=*/part-*")):
        name = f.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(f.getPath(), hadoop.Path(f"{root}/{name}.json.gz"))
    return root


def backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill in batches that fails after each of its steps in turn and is called again until it is
    through: rows per day of Bronze, Silver and fact."""
    raw_root, paths = _hourly_dumps(spark, sf_dir), medallion.LakePaths(scratch_dir(spark, "lake-backfill"))
    days = driver.load_events(spark, sf_dir).agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    to_fail = list(medallion.STEPS)

    def fail(step: str, *_: dt.date) -> None:
        if to_fail and step == to_fail[0]:
            raise InterruptedError(f"after {to_fail.pop(0)}")

    for _ in range(len(to_fail) + 1):
        try:
            medallion.backfill(spark, paths, raw_root, *days, batch_days=32, after=fail)
            break
        except InterruptedError:
            continue
    tables = {"bronze": bronze.read_bronze(spark, paths.bronze), "silver": medallion.read_silver(spark, paths), "fact_events": medallion.gold_tables(spark, paths)["fact_events"]}
    counts = [t.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_events")).select(F.lit(k).alias("table"), "event_date", "n_events") for k, t in tables.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


# --- losses, gaps and the model -------------------------------------------------------


def silver_cast_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that the casts to the contract lose, by column and day."""
    raw, number = driver.as_bronze(driver.events_with_bad_rows(driver.load_events(spark, sf_dir))), F.regexp_replace("id", "x", "").cast("bigint")
    actor = F.when(number % 7 == 0, F.concat(F.lit("bad-"), number % 3)).otherwise(F.col("actor.id"))
    repo = F.when(number % 11 == 0, "none").otherwise(F.col("repo.id"))
    public = F.when(number % 13 == 0, "maybe").when(number % 17 == 0, F.lit(None)).otherwise(F.col("public"))
    raw = raw.withColumns({"actor": F.col("actor").withField("id", actor), "repo": F.col("repo").withField("id", repo), "public": public})
    return silver.cast_losses(raw)


def missing_hour_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive hours without events: hours of every day, a night, three whole days."""
    gone = "event_hour in (5, 6, 17) or event_date in (date'2024-01-11', date'2024-01-12', date'2024-01-13') or (event_date = date'2024-01-20' and event_hour > 20) or (event_date = date'2024-01-21' and event_hour < 4)"
    slv = _silver(spark, sf_dir)
    return bronze.missing_runs(bronze.hour_coverage(bronze.observed_hour_grid(slv), slv.where(f"not ({gone})")))


def _fit_config() -> churn.ChurnConfig:
    return churn.ChurnConfig(split_date=CHURN_SPLIT, min_events_in_train=5, entity="actor_id", distinct_col="repo_id", max_iter=500, reg_param=0.01)


def churn_fit_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4-M7/C11: the saved model's coefficients meet the first-order conditions of the fit (slopes in thousandths)."""
    config, at = _fit_config(), scratch_dir(spark, "fit-model")
    features = churn.build_features(_fact(spark, sf_dir), config)
    model, _ = churn.train(features, config, spark)
    churn.save_model(model, at)
    train, _ = churn.split(features, config)
    slopes = churn.fit_conditions(churn.load_model(at), train, config)
    return slopes.select("term", F.round(F.abs("slope") * 1000).cast("bigint").alias("thousandths"))


def churn_batch_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities scored by the reloaded model of the best of two runs: every score is the logistic formula's."""
    paths = medallion.LakePaths(scratch_dir(spark, "lake-scores"))
    silver.write_silver(_silver(spark, sf_dir), paths.silver, dynamic=False)
    medallion.build_gold(spark, paths)
    for config in (_fit_config(), _actor_config()):
        medallion.train_churn(spark, paths, config)
    scored = medallion.score_churn(spark, paths, "accuracy")
    model = churn.load_model(churn.best_run(spark, paths.ml_runs, "accuracy")["model_path"])
    same = F.abs(F.col("score") - churn.formula(model)) < 1e-9
    return scored.select("actor_id", "n_events", "churned", same.alias("as_formula"), (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("as_score"))


# --- Bloom filters and buckets ----------------------------------------------------------


def bloom_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup on a column the layout is not clustered by: Bloom filters of its row groups."""
    path = scratch_dir(spark, "layout-bloom")
    layout.write_bloom(layout.cluster_by(_fact(spark, sf_dir), ["repo_id"], n_files=8), path, ["actor_id"], 10_000)
    return _count(spark.read.parquet(path).where(F.col("actor_id") == F.lit(LOOKUP_KEY)))


def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of ``join_shuffle`` over tables bucketed by the key: neither side is shuffled."""
    stg = _stg(spark, sf_dir)
    tables = {"fact": marts.fact_events(stg), "dim": marts.dim_repo(stg).select("repo_id", "repo_name", "total_events")}
    made = {}
    for name, df in tables.items():
        path = scratch_dir(spark, f"bucketed-{name}")
        made[name] = layout.write_bucketed(df, path.rsplit("/", 1)[-1].replace("-", "_"), "repo_id", 8, path)
    return layout.join_bucketed(made["fact"], made["dim"], "repo_id").select("event_id", "repo_id", "repo_name", "total_events")
