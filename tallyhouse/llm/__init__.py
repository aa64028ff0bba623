"""Operators of a training-data pipeline, each with the query that applies it to a whole table."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MODULES = [
    "line_dedup",
    "mixing",
    "packing",
    "order_minhash",
    "topk_search",
    "fingerprints",
    "substring_dedup",
    "lm_scoring",
    "language_id",
    "url_filter",
    "prefix_trie",
    "warc",
    "centroid_clustering",
]

# functions that run in tasks travel with the job, so executors need not have this package
cloudpickle.register_pickle_by_value(import_module(__name__))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")
