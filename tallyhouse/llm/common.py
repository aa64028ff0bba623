"""Written stages in the shared folder, and the tables the queries read."""

from __future__ import annotations

import gc
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.context import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop_path(spark, path, lambda fs, p: fs.deleteOnExit(p))
    return path


def hadoop_path(spark: SparkSession, path: str, act) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    act(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p)


class Stages:
    """Tables written during one operator run.

    ``write`` cuts the lineage: what follows reads files that survive the loss of
    an executor. ``drop`` deletes tables no later step reads.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame, wide: bool = False) -> DataFrame:
        """``df`` as a table; one that is ``wide`` holds texts and is packed more tightly."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path, compression="zstd" if wide else None)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Let Spark delete shuffle files that no live DataFrame needs any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        for name in names:
            hadoop_path(self.spark, self.paths.pop(name), lambda fs, p: fs.delete(p, True))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
