"""Session helpers: a configured SparkSession and the shared work folder.

Library functions never build their own session; they take the caller's.
``build_session`` is for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. All are public Spark SQL confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # AQE splits a hot key's shuffle partition in sort-merge / shuffled-hash
    # joins (the streamed side of a left outer join can be split).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "orderlake", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """Session for tests, the bench and jobs. ``event_log_dir`` turns on
    Spark's event log there (stage and task times without the web UI)."""
    master = master or os.environ.get("ORDERLAKE_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("ORDERLAKE_DRIVER_MEMORY", "8g"))
    if master.startswith("local"):
        # Local runs only: skip the checksum side files of the local
        # filesystem (each costs a forked chmod without native Hadoop libs).
        conf.setdefault("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
    if event_log_dir:
        os.makedirs(event_log_dir.split(":", 1)[-1], exist_ok=True)
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and run-scoped tables.

    Taken from ``spark.checkpoint.dir`` (or an already set checkpoint dir).
    Only a local-mode session without one gets a private temp folder; a
    cluster session without a shared folder is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (cluster mode)")
    path = tempfile.mkdtemp(prefix="orderlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, run-scoped folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/orderlake/{name}-{uuid.uuid4().hex[:12]}"
