"""Session settings the pipeline relies on (the caller owns the session).

Nothing here builds a session for production use; :func:`configure` sets the
SQL confs on whatever session it is given, and :func:`scratch_dir` resolves a
shared folder for intermediate tables from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: SQL confs applied by :func:`configure`. AQE re-plans joins and coalesces
#: or splits shuffle partitions at runtime; UTC keeps timestamps stable.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of coalesced / split shuffle partitions, hence of the files
    # a rebalanced write produces
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession, extra: dict[str, str] | None = None) -> SparkSession:
    """Apply :data:`DEFAULT_CONF` plus ``extra`` to a live session."""
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "eventlake", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, checkpoint folder set)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EVENTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventlake-ckpt-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    The session is left as it is. Without the setting only a ``local`` master,
    whose driver and executors are one process, gets a temporary folder; on a
    cluster executors would each write to a disk of their own, so it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- a remote (Connect) session has no SparkContext handle
        sc = None
    configured = spark.conf.get("spark.checkpoint.dir", None) if sc is None else sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if sc is not None and re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        if sc.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="eventlake-ckpt-")
        return _LOCAL_FOLDERS[sc.applicationId]
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


#: folders of local sessions without the setting, by application
_LOCAL_FOLDERS: dict[str, str] = {}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for an intermediate table under the checkpoint dir."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/eventlake-scratch/{name}-{uuid.uuid4().hex[:12]}"
