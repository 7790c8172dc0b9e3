"""Session construction and the shared scratch location.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a
folder every executor can reach; we only read it.  Tests and the local bench
build their own session and point that setting at a fresh local folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins/aggregations from runtime
# statistics (broadcast when a side turns out small, split skewed partitions,
# coalesce tiny ones); UTC pins date casts so Spark and SQL oracles agree.
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lodgelake") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for k, v in SCALE_CONFS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_session(app_name: str = "lodgelake") -> SparkSession:
    """The session as submitted: master, memory and partition counts are those
    of spark-submit or of the session that runs already."""
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """The one setting that results depend on; sizes and AQE stay the cluster's."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (and share its folders)."""
    return re.match(r"local($|\[)", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  Where it is unset, a local
    folder is made for a local master only; on a cluster that is an error, as
    executors would write to their own disks."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="lodgelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


#: Bytes of Parquet to a shuffle partition of a step: what a task then sorts stays
#: in memory.  AQE puts small partitions together.
STEP_BYTES = 16 << 20


@contextmanager
def own_step(spark: SparkSession, source_bytes: int = 0):
    """For a table that is written as a step of its own, from ``source_bytes`` of
    Parquet: it has a shuffle partition for each ``STEP_BYTES`` at least, and its
    shuffle files go when it ends, not when the driver happens to collect garbage.
    The caller's settings hold again afterwards."""
    conf, initial = spark.conf, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    wanted = -(-source_bytes // STEP_BYTES)
    if wanted > int(conf.get(initial, None) or conf.get("spark.sql.shuffle.partitions")):
        own[initial] = str(wanted)
    before = {k: conf.get(k, None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
