"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where nothing is set and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="logtide-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def gone_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a folder when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


#: Rows of a small table's file.
FILE_ROWS = 200_000


class Scratch:
    """Writes tables that cut lineage, so that a lost executor costs a re-read and not a re-run of the whole plan.

    Results may be read as long as the application runs; what is left of the tables then goes.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        gone_at_exit(spark, self.root)

    def cut(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """Write a table and read it back; ``rows``: how many there are at most, where that is known, so that a small table is few files."""
        path = f"{self.root}/{name}"
        if rows is not None:
            df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle(self) -> None:
        """Let Spark delete the shuffle files of plans that are done; it does so when the driver collects its garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
