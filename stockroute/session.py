"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from real shuffle sizes
# (runtime broadcast of a small stock profile, skew splitting of hot
# materials), and the session time zone pins timestamp text to UTC.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Skip per-call Python stack capture while building plans (fewer JVM round trips).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stockroute", extra: dict | None = None) -> SparkSession:
    """A session for local runs and tests; on a cluster pass ``master=None``
    and let the launcher decide."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` as
    the cluster names it. Unset, it is an error on a cluster, where a local
    folder would be another one on every machine; a one-process local session
    gets a fresh folder of its own."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="stockroute-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path below the scratch root (never reused)."""
    return os.path.join(scratch_root(spark), f"stockroute-{label}-{uuid.uuid4().hex}")
