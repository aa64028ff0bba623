"""One run from file to gate: load, then build and test layer by layer, then report.

    spark-submit tallyhouse/daily.py FILES ROOT RUN_ID [YYYY-MM-DDTHH:MM:SS]
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.context import RunContext
from tallyhouse.plans.warehouse import LAYERS, Warehouse
from tallyhouse.quality.declared import barrier
from tallyhouse.quality.report import gate, quality_report
from tallyhouse.sources.raw import RAW_COLUMNS, check_input, profile


@dataclass(frozen=True)
class Outcome:
    report: dict
    tests: dict[str, int]
    failing_rows: dict[str, str]
    profile: dict


def daily_run(spark: SparkSession, files: str, root: str, ctx: RunContext) -> Outcome:
    """Build every layer from ``files`` under ``root``; raises when a check fails.

    The declared tests of a layer stand between it and the next: a failed one of
    severity ``error`` in staging leaves the marts of the last run as they are, one in
    the marts leaves no report. The load profile, the grades, the rows that broke a
    test and the report are tables under ``test_results``.
    """
    results = f"{root}/test_results"
    scan = check_input(spark, files)
    house = Warehouse(spark, root, lambda: scan, ctx)
    tables: dict[str, DataFrame] = {}
    stored: dict[str, str] = {}
    for layer in dict.fromkeys(LAYERS.values()):
        built = house.build_layer(layer)
        tables |= built
        if layer == "raw":
            profile(built["customer_transactions"].select(*RAW_COLUMNS)).write.mode("overwrite").parquet(f"{results}/profile")
        _, paths = barrier(layer, list(built), tables, ctx, results)
        stored |= paths
    quality_report(tables).write.mode("overwrite").parquet(f"{results}/report")
    summary = gate(spark.read.parquet(f"{results}/report"))
    graded = spark.read.parquet(f"{results}/declared")
    statuses = {r["status"]: r["count"] for r in graded.groupBy("status").count().collect()}
    return Outcome(summary, statuses, stored, spark.read.parquet(f"{results}/profile").first().asDict())


if __name__ == "__main__":
    files, root, run_id, *when = sys.argv[1:]
    moment = datetime.fromisoformat(when[0]) if when else datetime.now().replace(microsecond=0)
    session = SparkSession.builder.appName(f"tallyhouse {run_id}").getOrCreate()
    print(daily_run(session, files, root, RunContext(moment, run_id, files.rstrip("/").rsplit("/", 1)[-1])))
