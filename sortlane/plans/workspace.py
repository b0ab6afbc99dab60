"""Folders for intermediate tables, below the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sortlane.session import checkpoint_dir


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path that nothing has written to yet; it is deleted when the application ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Compute ``df`` once, as a table in the shared folder.

    For frames that many jobs read: nothing is recomputed when an executor is lost, and every
    reader takes only the columns it needs.
    """
    path = new_folder(df.sparkSession, purpose)
    # Files of an even size, whatever the partitions were.
    df.hint("rebalance").write.parquet(path)
    return df.sparkSession.read.parquet(path)
