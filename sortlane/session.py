"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# AQE merges small reducers and splits skewed partitions at run time, so the only static
# choice is an upper bound on reducers that is generous for a large cluster.
DEFAULTS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "sortlane", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the cluster's setting, else one for a local run.

    ``spark.checkpoint.dir`` names the shared folder. Only a local master without that
    setting gets a folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder is lost together with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        folder = configured
    else:
        folder = sc.getCheckpointDir()
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="sortlane-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder
