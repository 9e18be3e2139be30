"""Session helpers: the settings the library relies on, and a shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on. ANSI casts raise on bad input like the
# warehouse CAST does; UTC keeps zone-less timestamps stable.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "carelake") -> SparkSession:
    """A local session for tests and the benchmark (not for cluster use)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CARELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Long single-JVM runs (tests, bench): free finished jobs' shuffle
        # files and broadcasts promptly.
        .config("spark.cleaner.periodicGC.interval", "2min")
        # Whole-stage codegen emits methods above HotSpot's 8000-byte JIT
        # limit for wide projections; let the JIT compile them anyway.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Pin the semantic settings on an existing session (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables: the
    cluster's ``spark.checkpoint.dir``, or the folder set on the context. Only
    a local master without either gets a temporary folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="carelake-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/carelake/{name}-{uuid.uuid4().hex}"
