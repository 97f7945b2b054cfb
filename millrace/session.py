"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


# For the cluster's session builder.  Broadcasts stay behind a size check: the
# planner's estimate first, the measured size again at run time.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.autoBroadcastJoinThreshold": "128m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def local_session(cpus: int = 8, partitions: int = 8, app: str = "millrace") -> SparkSession:
    """A single-JVM session for tests and the bench; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is only made where the setting is missing and every
    executor lives in this process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="millrace-")
        folder = _local_folders[app]
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"
