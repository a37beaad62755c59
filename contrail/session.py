"""SparkSession construction and cluster-aware settings."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Sizes are per-cluster decisions; these are the
# defaults for a laptop / CI run and are overridden by spark-submit on a cluster.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a long session of many small queries: keep the driver's status store small
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "10000",
    "spark.sql.ui.retainedExecutions": "50",
}


def _local_heap() -> str:
    """Local mode runs driver and executors in one JVM: give it most of the
    machine (Spark's 1g default makes long sessions GC-bound)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(2, min(16, int(total * 0.6 / 2**30)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def get_spark(app: str = "contrail", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session.

    When a session already exists it is reused untouched except for ``extra``.
    In a driver that was submitted (``spark-submit``, or a master named in
    ``PYSPARK_SUBMIT_ARGS``) the submitted settings stand: no master, heap or
    partition count of ours is set, and of our other defaults only the SQL
    settings that were left unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in (extra or {}).items():
            active.conf.set(k, v)
        return active
    if submitted():
        spark = SparkSession.builder.getOrCreate()
        given = spark.sparkContext.getConf()
        unset = {k: v for k, v in _BASE_CONF.items() if k.startswith("spark.sql.") and not given.contains(k)}
        for k, v in {**unset, **(extra or {})}.items():
            if spark.conf.isModifiable(k):
                spark.conf.set(k, v)
        checkpoint_dir(spark)
        return spark
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = SparkSession.builder.appName(app).master(f"local[{cpus}]")
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf.setdefault("spark.driver.memory", os.environ.get("CONTRAIL_DRIVER_MEMORY", _local_heap()))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def submitted() -> bool:
    """Whether this driver was started with settings of its own."""
    return "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``DataFrame.checkpoint`` and
    versioned tables).

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    leave it unset and gets a temporary folder; executors elsewhere couldn't
    see one, so any other master without the setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="contrail-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files are freed when it has ended, not when the driver next collects garbage.

    For steps that write tables and read them again: what one step shuffled, no later one needs, and all of
    a job's steps together would fill the disks."""
    was = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, was)
