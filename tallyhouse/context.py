"""What one warehouse run knows about itself: its clock, its id, its folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIRS: dict[str, str] = {}


@dataclass(frozen=True)
class RunContext:
    """Clock and lineage of a run. Models never read the wall clock themselves."""

    run_ts: datetime
    run_id: str
    source_file: str

    @property
    def as_of(self) -> date:
        return self.run_ts.date()

    @property
    def today(self) -> Column:
        return F.lit(self.as_of)

    @property
    def now(self) -> Column:
        # through text, so that neither Python's nor the session's zone shifts it
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder: on a
    cluster such a folder would exist on one machine alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tallyhouse-")
        delete_at_end(spark, _LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete a path when the application ends."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage.

    Numbers that a shuffle gave, such as the ranges of a sampled order, then stay what
    they are, however often tasks are run again. Deleted when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    delete_at_end(spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
