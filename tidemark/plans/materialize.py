"""Cutting lineage through tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    In local mode, where the only machine sees every folder, one is made for the process where none is set,
    and goes with it. On a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    own = tempfile.mkdtemp(prefix="run-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """A folder of stored tables with an owner: ``close`` (or the end of a ``with`` block) drops them all.

    Results that read the tables must be written or collected before.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{(folder or shared_folder(spark)).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
        self.tables = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a table that several branches read, and return it read back.

        The readers get true file sizes (so joins choose broadcast on facts), column pruning,
        and files that outlive any executor.
        """
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def materialize(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``Scratch.keep``; without an owner the table stays in the shared folder, whose cleaning is the cluster's."""
    return (scratch or Scratch(df.sparkSession)).keep(df)
