"""Session helpers: a local session for tests and benchmarks, and the shared
scratch location for jobs that must cut lineage or stage writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and bench.py. On a cluster, use the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rental_mart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; a private folder is created only when a
    local-mode session has none (tests). A cluster session without it fails."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged writes and "
                           "checkpoints must survive the loss of any one machine")
    local = tempfile.mkdtemp(prefix="rental_mart_ckpt_")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location. Each gets a
    private parent, so looking beside it (swap recovery) touches nothing else."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    parent = f"{base.rstrip('/')}/rental_mart/{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(parent)
    return f"{parent}/{name}"


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process created (once nothing reads them)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            n += 1
    return n


def ansi_enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"


def require_ansi(spark: SparkSession) -> None:
    """Text casts must fail on bad input as the source database does; that needs
    ANSI mode (the Spark 4 default)."""
    if not ansi_enabled(spark):
        raise RuntimeError("rental_mart needs spark.sql.ansi.enabled=true so bad text fails instead of turning NULL")


__all__ = ["local_session", "ensure_checkpoint_dir", "scratch_path", "drop_scratch", "require_ansi", "ansi_enabled"]
