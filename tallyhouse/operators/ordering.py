"""Neighbours and ranks in groups of any size.

A window function sorts a whole group in one task. That is fine for many small
groups and hopeless for one huge one, or for no grouping at all. Beyond a task's
worth of rows the table is therefore written in ranges of its whole sort key, grouping
columns first, and each range is sorted by itself. What one range must know of the
others, its neighbour's edge row or how many rows lie ahead, is one small row per range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.context import scratch_table

# rows that a single task may sort
ROWS_PER_TASK = 2_000_000
# rows, one per range, that may be broadcast
MAX_BROADCAST_RANGES = 500_000
# rows one task may write out when a counted row is repeated
REPEATS_PER_TASK = 1_000_000


def sort_key(keys: list[str], order: list[str]) -> Column:
    """One value that compares like the rows do: by ``keys``, then ``order`` with NULLs last."""
    return F.struct(*keys, *[F.struct(F.col(c).isNull().alias("missing"), c).alias(f"by_{c}") for c in order])


def in_ranges(df: DataFrame, keys: list[str], order: list[str], rows_per_task: int, total: int) -> DataFrame:
    """``df`` written with ``__range``: later ranges hold later rows of the whole sort key.

    No range holds more than ``rows_per_task`` rows, unless all of them are equal in the
    key: a larger one is cut again, and as sampled cut points may miss values beside a
    very common one, the rows equal to its lowest and highest key are parted from the rest.
    """
    by = [*[F.col(k).asc() for k in keys], *[F.col(c).asc_nulls_last() for c in order]]
    at = sort_key(keys, order)
    parts = -(-total // rows_per_task) + 1
    number = F.spark_partition_id().cast("long")
    table = scratch_table(df.repartitionByRange(parts, *by).withColumn("__range", number), "ranges")
    while True:
        sizes = table.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"), F.min(at).alias("__low"), F.max(at).alias("__high"))
        # at most total / rows_per_task ranges are too large
        large = scratch_table(sizes.filter((F.col("__n") > rows_per_task) & (F.col("__low") != F.col("__high"))), "large")
        rows = large.agg(F.sum("__n")).first()[0]
        if not rows:
            return table
        pieces = 2 * -(-rows // rows_per_task) + 1
        apart = F.when(at == F.col("__low"), 0).when(at == F.col("__high"), 2).otherwise(1)
        marked = table.join(F.broadcast(large), "__range").withColumn("__apart", apart).drop("__n", "__low", "__high")
        place = F.struct(number.alias("p"), "__apart")
        cut = scratch_table(marked.repartitionByRange(pieces, "__range", "__apart", *by).withColumn("__place", place).drop("__apart"), "cut")
        kept = table.join(F.broadcast(large.select("__range")), "__range", "left_anti")
        step = F.lit(3 * pieces)
        inner = F.col("__place.p") * 3 + F.col("__place.__apart")
        table = kept.withColumn("__range", F.col("__range") * step).unionByName(
            cut.withColumn("__range", F.col("__range") * step + inner).drop("__place")
        )


def _look_up(rows: DataFrame, found: DataFrame, ranges: int) -> DataFrame:
    # the hint is given only where the number of ranges is known to be small
    return rows.join(F.broadcast(found) if ranges <= MAX_BROADCAST_RANGES else found, "__range", "left")


def _same(keys: list[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}.{k}")) for k in keys], F.lit(True))


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    step: int = 1,
    rows_per_task: int = ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """Add ``name``: ``value`` of the next (``step=1``) or previous (``-1``) row.

    Rows are ordered within ``keys`` by ``order``, ascending, NULLs last. The order
    must be total within a group. ``value`` must not be NULL where a row exists, so
    wrap nullable values in a struct; NULL then means there is no such row. ``total``
    may give an upper bound of the rows that is cheaper to get than a count.
    """
    ascending = [F.col(c).asc_nulls_last() for c in order]
    move, pick = (F.lead, F.min_by) if step > 0 else (F.lag, F.max_by)

    def moved(*groups: str) -> Column:
        return move(value).over(Window.partitionBy(*groups).orderBy(*ascending))

    total = df.count() if total is None else total
    if total <= rows_per_task:
        return df.withColumn(name, moved(*keys))
    ranged = in_ranges(df, keys, order, rows_per_task, total)
    # the row of each range that the neighbouring range must look up
    edges = ranged.groupBy("__range").agg(pick(F.struct(*keys, value.alias("__value")), sort_key(keys, order)).alias("__edge"))
    found = edges.select("__range", move("__edge").over(Window.orderBy("__range")).alias("__beyond"))
    inner = ranged.withColumn(name, moved("__range", *keys))
    beyond = F.when(_same(keys, "__beyond"), F.col("__beyond.__value"))
    return (
        _look_up(inner, found, -(-total // rows_per_task))
        .withColumn(name, F.coalesce(F.col(name), beyond))
        .drop("__beyond", "__range")
    )


def with_rank(
    df: DataFrame,
    keys: list[str],
    column: str,
    name: str,
    largest_group: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``name``: the rank by ``column`` within ``keys``, the largest value first.

    ``largest_group`` is a known bound on the rows of a group, if there is one; within
    ``rows_per_task`` it saves counting the rows.
    """

    def ranked(*groups: str) -> Column:
        return F.rank().over(Window.partitionBy(*groups).orderBy(F.col(column).desc_nulls_first()))

    total = 0 if largest_group is not None and largest_group <= rows_per_task else df.count()
    if total <= rows_per_task:
        return df.withColumn(name, ranked(*keys))
    # rows that tie may lie in several ranges, so a hash of the row parts them
    spread = df.withColumn("__spread", F.xxhash64(*df.columns))
    order = [column, "__spread"]
    ranged = in_ranges(spread, keys, order, rows_per_task, total)
    row = F.struct(*keys, F.col(column).alias("__value"))
    ends = ranged.groupBy("__range").agg(
        F.min_by(row, sort_key(keys, order)).alias("__first"), F.max_by(row, sort_key(keys, order)).alias("__last")
    )
    ranges = -(-total // rows_per_task)
    opening = _look_up(ranged, ends, ranges).filter(_same(keys, "__first"))
    sizes = opening.groupBy("__range", "__first").agg(
        F.count(F.lit(1)).alias("group_rows"), F.count_if(F.col(column).eqNullSafe(F.col("__first.__value"))).alias("value_rows")
    )
    # a range's last group goes on in the ranges that begin with the same group
    asked = ends.select("__range", F.col("__last").alias("row"), F.lit(0).alias("kind"), F.lit(0).alias("group_rows"), F.lit(0).alias("value_rows"))
    given = sizes.select("__range", F.col("__first").alias("row"), F.lit(1).alias("kind"), "group_rows", "value_rows")
    group = [F.col(f"row.{k}") for k in keys]

    def later(of: str, *within: Column) -> Column:
        order = Window.partitionBy(*within).orderBy(F.col("__range").desc(), "kind")
        return F.coalesce(F.sum(of).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    ahead = asked.unionByName(given).select(
        "__range", "row", "kind", later("group_rows", *group).alias("__ahead"), later("value_rows", F.col("row")).alias("__ties")
    )
    found = ahead.filter("kind = 0").select("__range", F.col("row").alias("__last"), "__ahead", "__ties")
    inner = ranged.withColumn(name, ranked("__range", *keys))
    tied = F.when(F.col(column).eqNullSafe(F.col("__last.__value")), F.col("__ties")).otherwise(0)
    beyond = F.when(_same(keys, "__last"), F.col("__ahead") - tied).otherwise(0)
    return (
        _look_up(inner, found, ranges)
        .withColumn(name, (F.col(name) + beyond).cast("int"))
        .drop("__last", "__ahead", "__ties", "__range", "__spread")
    )


def repeat_rows(df: DataFrame, times: str, per_task: int = REPEATS_PER_TASK) -> DataFrame:
    """Each row as often as its ``times`` says, then without that column.

    A large count is split into blocks that spread over tasks, so no task builds
    or writes more than one block of copies at a time.
    """
    n = F.col(times)
    blocks = df.filter(n > 0).withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / per_task).cast("bigint")))
    )
    left = F.least(n - F.col("__block") * per_task, F.lit(per_task).cast("bigint"))
    return (
        blocks.repartition(*df.columns, "__block")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
        .drop("__block", "__copy", times)
    )
