"""Tables that are replaced as a whole, without a moment in which there is none.

A table is a folder of numbered versions. A new one is written beside the old, its rows
are counted, and only then a mark in it makes it the current one; creating that empty
file is one step on any store. A job that is lost before leaves the old rows readable.
The version before the current one stays for readers that have begun with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.errors import LoadError

MARK = "_reconciled"


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Every version's number, and whether it was completed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    numbers = sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())
    return {n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{_folder(path, n)}/{MARK}")) for n in numbers}


def _folder(path: str, number: int) -> str:
    return f"{path}/v{number:08d}"


def current(spark: SparkSession, path: str) -> str:
    """The folder of the newest completed version."""
    done = [n for n, completed in _versions(spark, path).items() if completed]
    if not done:
        raise LoadError(f"{path} holds no completed table")
    return _folder(path, done[-1])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Replace a table by ``df``, which may read it; running it again gives the same table.

    Returns the row count seen while writing, which the stored rows (counted from the
    file footers) must agree with. One run writes a table at a time.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    before = _versions(spark, path)
    folder = _folder(path, max(before, default=0) + 1)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    rows, stored = seen.get["rows"], spark.read.schema(df.schema).parquet(folder).count()
    if stored != rows:
        raise LoadError(f"{folder} holds {stored} rows, the source had {rows}")
    mark = jvm.org.apache.hadoop.fs.Path(f"{folder}/{MARK}")
    fs = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(mark, True).close()
    kept = max((n for n, completed in before.items() if completed), default=None)
    for n in before:
        if n != kept:
            fs.delete(jvm.org.apache.hadoop.fs.Path(_folder(path, n)), True)
    return rows


def reconcile(spark: SparkSession, path: str, expected: int) -> int:
    """Compare the stored row count (read from the file footers) with the source's."""
    stored = read_table(spark, path).count()
    if stored != expected:
        raise LoadError(f"{path} holds {stored} rows, the source had {expected}")
    return stored
