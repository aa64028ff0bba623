"""Grouping with a distinct count beside other aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aggregate_with_distinct(
    df: DataFrame,
    keys: Sequence[str],
    aggregates: Sequence[Column],
    distinct: str,
    name: str,
    nullable_keys: bool = False,
) -> DataFrame:
    """``groupBy(keys)`` with the aggregates and the distinct values of one column.

    In one aggregate, Spark would shuffle the buffers of every aggregate once per
    distinct value, which is about once per input row. Apart, the aggregates combine
    map-side down to the groups, the distinct pass shuffles nothing but keys and
    values, and the two results meet on the keys they are already partitioned by.
    """
    sums = df.groupBy(*keys).agg(*aggregates)
    values = df.select(*keys, distinct).distinct().groupBy(*keys).agg(F.count(distinct).alias(name))
    if not nullable_keys:
        return sums.join(values, list(keys), "left")
    renamed = values.select(*[F.col(k).alias(f"__{k}") for k in keys], name)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return sums.join(renamed, same, "left").drop(*[f"__{k}" for k in keys])
