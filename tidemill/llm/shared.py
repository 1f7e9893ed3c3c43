"""Where intermediate tables go, and small helpers that several corpus operators use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; one of our own only where that is unset (tests)."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
        if not at:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = "file://" + tempfile.mkdtemp(prefix="tidemill-")
            spark.sparkContext.setCheckpointDir(at)
    return at if "://" in at or at.startswith("file:") else f"file://{at}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table written to the shared folder, which cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of tables from written() that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Bytes of all texts and the number of rows."""
    row = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(row["b"]), int(row["n"])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
