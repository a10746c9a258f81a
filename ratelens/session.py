"""Session helpers.

Cluster settings (executor sizes, ``spark.checkpoint.dir``) belong to the
cluster; this module only fills in what a local run or a test needs and
never overrides a value that is already set.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings a job relies on for correct, repeatable results.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ratelens", driver_memory: str | None = None) -> SparkSession:
    """Return the active session, creating a local one if none exists.

    ``driver_memory`` matters in local mode only, where the driver JVM runs
    the tasks (it must be set before that JVM starts)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false")
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in _REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark application.

    Functions that run in Python workers are pickled by reference, so the
    workers must be able to import the package; it need not be installed on
    the cluster's machines.  The files go through Spark's own file server.
    """
    sc = spark.sparkContext
    if getattr(sc, "_ratelens_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="ratelens-ship-"), "ratelens_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith((".py", ".json")):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    sc._ratelens_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Read from ``spark.checkpoint.dir``; only a local master (whose tasks run
    on this machine) may go without: a fresh local folder is then created and
    registered.  On a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ratelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # core confs are read-only at runtime on some versions
        pass
    return local
