"""Spark session settings and the shared folder for materialised results.

The engine itself never creates a session: every operator takes DataFrames
and returns DataFrames.  ``get_session`` is a convenience for tests, the
bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: folder within the shared one's ``twinrun`` that fresh paths lie in (see ``sources.pin.scratch``)
FOLDER: ContextVar[str] = ContextVar("twinrun_folder", default="")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "twinrun") -> SparkSession:
    """A session tuned for replaying history: AQE on, skew splitting on.

    ``spark.sql.shuffle.partitions`` is an upper bound; adaptive execution
    coalesces small partitions at run time (to about 128 MB each) and splits
    skewed join partitions.  On a cluster size it to roughly the largest
    shuffle divided by 128 MB, so every reduce task fits in executor memory.
    """
    master = master or os.environ.get("TWINRUN_MASTER", "local[8]")
    builder = SparkSession.builder.master(master)
    if shuffle_partitions or master.startswith("local"):
        # local: a couple of partitions per core; on a cluster keep the
        # cluster's own sizing unless a number is given explicitly
        parts = shuffle_partitions or max(8, 2 * _cores(master))
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.driver.memory", os.environ.get("TWINRUN_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


# Adaptive execution as the replay plans expect it.  All are runtime SQL
# settings that change how a plan executes, never what it returns.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot document even when that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a task of a diff holds sorts and hash tables of both versions at once, some
    # fifty times what it reads: small partitions are not joined to large ones
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "16m",
    # the JVM interprets longer methods: plans of wide results then run piece by piece
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: rows of history for each partition of a shuffle
ROWS_PER_PARTITION = 250_000


def configure(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive-execution settings the replay plans rely on
    (skewed join partitions are split even when a later operator then
    needs its own exchange)."""
    for k, v in ADAPTIVE.items():
        spark.conf.set(k, v)
    return spark


def size_shuffles(spark: SparkSession, tables: Iterable[DataFrame], rows: int = ROWS_PER_PARTITION) -> int:
    """Let shuffles start with a partition for every ``rows`` rows of history, at
    least ``spark.sql.shuffle.partitions``; return their number.  A reduce
    task's memory then stays the same however long history is; adaptive
    execution joins partitions that turn out small."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(t.count() for t in tables) // rows))
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    return n


def _cores(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[len("local["):-1].split(",")[0]
        if inner == "*":
            return os.cpu_count() or 8
        if inner.isdigit():
            return int(inner)
    return 8


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must point to storage every executor can reach
    (HDFS, object store); it is read, never overridden.  Only when it is unset
    and the master is local (tests) is a private temporary folder used.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is not None:  # set on the context instead
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: point it at shared storage so that "
            "materialised replay results survive the loss of an executor")
    local = tempfile.mkdtemp(prefix="twinrun-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, local)
    sc.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder, e.g. for a pin."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts) if parts else "tmp"
    return f"{root}/twinrun/{FOLDER.get()}{leaf}-{uuid.uuid4().hex[:12]}"
