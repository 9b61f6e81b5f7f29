"""Window dedup vs by-exception dedup on wide synthetic rows.

Usage: python tools/dedup_tradeoff.py [rows]

Generates ``rows`` events with ~1 KB payloads (plus 3% replayed ids), then
times both dedup paths (median of 3 after a warm-up): the window over all
rows, and the narrow duplicate-id pass + by-exception dedup.
"""

import statistics
import sys
import tempfile
import time

sys.path.insert(0, "/root/repo")
from pyspark.sql import functions as F
from eventlake.session import local_session
from eventlake.operators import silver
spark = local_session("wide", cores=8, shuffle_partitions=64)
n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
d = tempfile.mkdtemp(prefix="wide-")
payload = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 256) for i in range(16)])
base = spark.range(n).select(
    F.col("id").alias("event_id"), F.lit("PushEvent").alias("event_type"), (F.col("id") % 5000).alias("actor_id"),
    F.lit("u").alias("actor_login"), (F.col("id") % 700).alias("repo_id"), F.lit("r").alias("repo_name"),
    payload.alias("payload_json"), F.lit(True).alias("public"),
    F.timestamp_seconds(F.lit(1704067200) + F.col("id") % (30 * 86400)).alias("created_at"),
).withColumns({"event_date": F.to_date("created_at"), "event_hour": F.hour("created_at"),
               "_ingested_at": F.col("created_at"), "_silver_processed_at": F.current_timestamp()})
replay = base.where(F.col("id") % 33 == 0).withColumn("_ingested_at", F.col("_ingested_at") + F.expr("INTERVAL 1 DAY"))
base.unionByName(replay).write.parquet(d + "/in")
rows = spark.read.parquet(d + "/in")
print("input rows", rows.count(), file=sys.stderr)
def window():
    silver.deduplicate(rows).write.format("noop").mode("overwrite").save()
def by_exc():
    p = tempfile.mkdtemp(prefix="dups-", dir=d) + "/x"
    silver.duplicate_ids(rows).write.parquet(p)
    silver.deduplicate_by_exception(rows, spark.read.parquet(p)).write.format("noop").mode("overwrite").save()
for name, fn in [("window", window), ("by_exception", by_exc)] * 1:
    fn()
    ts = []
    for _ in range(3):
        t = time.perf_counter(); fn(); ts.append(time.perf_counter() - t)
    print(name, round(statistics.median(ts), 2))
