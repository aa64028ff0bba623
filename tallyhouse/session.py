"""A local session for tests and benchmarks. On a cluster, bring your own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "8g", name: str = "tallyhouse") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        # do not record a Python stack trace for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the JVM never compiles a method above 8000 bytes of code; a wide projection
        # runs faster as several smaller generated classes than as one such method
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
