"""Row groups skipped by Bloom filters; joins of bucketed tables without a shuffle."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from eventlake.operators import layout


def rows_read(df):
    """Rows that the scan of an executed query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    while "Scan" not in plan.getClass().getSimpleName():
        plan = plan.children().apply(0)
    return plan.metrics().get("numOutputRows").get().value()


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    # every row group spans almost the whole range of v; odd values occur nowhere
    df = spark.range(200_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(10**9)) * 2).alias("v")).repartition(2)
    plain, bloom = str(tmp_path / "plain"), str(tmp_path / "bloom")
    small = {"parquet.block.size": str(200_000), "parquet.enable.dictionary": "false"}
    df.write.options(**small).parquet(plain)
    layout.write_bloom(df, bloom, ["v"], 20_000, row_group_bytes=200_000)
    absent = 2 * 123_456_789 + 1
    lookup = lambda path, v: spark.read.parquet(path).where(F.col("v") == F.lit(v))
    assert rows_read(lookup(plain, absent)) > 190_000  # but for a short last row group
    assert rows_read(lookup(bloom, absent)) < 40_000
    present = df.where("id = 77").first().v
    assert lookup(bloom, present).count() == lookup(plain, present).count() >= 1
    assert 0 < rows_read(lookup(bloom, present)) < 100_000


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    fact = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500).alias("k"))
    dim = spark.range(450).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    names = [f"t_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    a = layout.write_bucketed(fact, names[0], "k", 6, str(tmp_path / "fact"))
    b = layout.write_bucketed(dim, names[1], "k", 6, str(tmp_path / "dim"))
    for how in ("inner", "left"):
        joined = layout.join_bucketed(a, b, "k", how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\bExchange\b", plan) and "SortMergeJoin" in plan
        want = fact.join(dim, "k", how)
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, want.collect()))
    assert len(list((tmp_path / "fact").glob("*.parquet"))) == 6
    for name in names:
        spark.sql(f"DROP TABLE {name}")
