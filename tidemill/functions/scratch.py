"""A folder that all executors share, for queries that write and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, deleted when the session's JVM ends; a temporary one only in local mode."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(at)
    path = f"{at.rstrip('/') if '://' in at or at.startswith('file:') else 'file://' + at.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path
