"""Generic tests. Each returns the rows that break a rule; no rows means it holds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.ordering import ROWS_PER_TASK, repeat_rows, with_neighbour
from tallyhouse.operators.shaping import slugify
from tallyhouse.sources.raw import union_all


def _count() -> Column:
    return F.count(F.lit(1))


# --- comparing two tables -------------------------------------------------------


def _paired_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str], left: str, right: str) -> DataFrame:
    """Counts of both tables side by side; a group one side lacks has NULL there."""
    if not group_by:
        both = union_all([df.select(F.lit(s).alias("s")) for s, df in ((left, a), (right, b))])
        return both.agg(*[F.count_if(F.col("s") == s).alias(s) for s in (left, right)])
    counted_a = a.groupBy(*[F.col(c).alias(f"{c}_a") for c in group_by]).agg(_count().alias(left))
    counted_b = b.groupBy(*[F.col(c).alias(f"{c}_b") for c in group_by]).agg(_count().alias(right))
    both = counted_a.join(counted_b, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by], "full")
    return both.select(*[f"{c}_{side}" for c in group_by for side in "ab"], left, right)


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts per group. Failures: the sum of ``diff_count``, NULL counted as 0."""
    return _paired_counts(a, b, group_by, "count_a", "count_b").withColumn(
        "diff_count", F.abs(F.col("count_a") - F.col("count_b"))
    )


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts per group. Failures: the sum of ``row_count_delta``."""
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    return _paired_counts(a, b, group_by, "count_our_model", "count_comparison_model").withColumn(
        "row_count_delta", F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    )


def rowcount_failures(column: str = "diff_count") -> Column:
    """Failures of the two tests above; a group on one side only adds none."""
    return F.sum(F.coalesce(F.col(column), F.lit(0)))


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, copies: bool = False) -> DataFrame:
    """Rows of one table that the other lacks, labelled with their side.

    One grouping over both tables answers both directions. Sets are compared, so a
    row's number of copies does not matter unless ``copies`` is given.
    """
    columns = list(columns or a.columns)
    tagged = a.select(*columns, F.lit(1).alias("__a"), F.lit(0).alias("__b")).union(
        b.select(*columns, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    sides = tagged.groupBy(*columns).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    side = F.when(F.col("__a") > F.col("__b"), "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    if copies:
        differing = sides.filter("__a <> __b").select(side, *columns, F.abs(F.col("__a") - F.col("__b")).alias("__n"))
        return repeat_rows(differing, "__n")
    return sides.filter("__a = 0 OR __b = 0").select(side, *columns)


def equality_failures() -> Column:
    """Differing rows, plus how far the two sides differ in number."""
    a, b = (F.count_if(F.col("which_diff") == s) for s in ("a_minus_b", "b_minus_a"))
    return _count() + F.abs(a - b)


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """Pairs of value and row count that only one of the tables has."""
    tagged = a.select(F.col(column).alias("value"), F.lit(1).alias("__a"), F.lit(0).alias("__b")).union(
        b.select(F.col(field), F.lit(0), F.lit(1))
    )
    counts = tagged.groupBy("value").agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    return (
        counts.filter("__a <> __b")
        .select("value", F.explode(F.array("__a", "__b")).alias("num_rows"))
        .filter("num_rows > 0")
    )


# --- rows that break a rule of their own ----------------------------------------


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None) -> DataFrame:
    """Rows for which the expression is false; NULL passes."""
    if column is not None:
        expression = f"{column} {expression}"
    rule = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~rule)


def outside(column: str, low: Any = None, high: Any = None, inclusive: bool = True) -> Column:
    """True where a value lies outside the bounds; NULL does not."""
    c = F.col(column)
    rule = F.lit(False)
    if low is not None:
        rule = rule | ~(c >= low if inclusive else c > low)
    if high is not None:
        rule = rule | ~(c <= high if inclusive else c < high)
    return rule


def accepted_range(df: DataFrame, column: str, low: Any = None, high: Any = None, inclusive: bool = True) -> DataFrame:
    return df.filter(outside(column, low, high, inclusive))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    value = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return df.select(value.alias(column)).filter(F.col(column) == "")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows whose two columns differ; NULL on either side passes."""
    return df.filter(F.col(actual) != F.col(expected))


# --- values ---------------------------------------------------------------------


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values outside the list, with their counts; NULL passes."""
    bad = df.filter(~F.col(column).isin(list(values)))
    return bad.groupBy(F.col(column).alias("value_field")).agg(_count().alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Values of the list that occur."""
    return df.filter(F.col(column).isin(list(values))).select(F.col(column).alias("value_field")).distinct()


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(_count().alias("n_records")).filter("n_records > 1")


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(_count().alias("__n")).filter("__n > 1").drop("__n")


def columns_match_set(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Column names that only the table or only the list has, compared without case."""
    have, want = {c.upper() for c in df.columns}, {c.upper() for c in expected}
    rows = [(c, None) for c in sorted(have - want)] + [(None, c) for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(rows, "relation_column string, input_column string")


# --- groups ---------------------------------------------------------------------


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups in which a column is NULL throughout; without groups, the whole table."""
    if not group_by:
        # one value settles it, so the scan stops at the first
        df = df.filter(F.col(column).isNotNull()).select(column).limit(1)
    return df.groupBy(*group_by).agg(F.count(column).alias("n_values")).filter("n_values = 0")


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value, NULLs aside.

    Smallest equal to largest says the same as one distinct value, and both
    combine map-side. Spark would sort for the smallest text, so texts are counted.
    """
    if isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)):
        pairs = df.select(*group_by, column).distinct().groupBy(*group_by)
        return pairs.agg(F.count(column).alias("n_distinct")).filter("n_distinct = 1")
    ends = df.groupBy(*group_by).agg(F.min(column).alias("__min"), F.max(column).alias("__max"))
    return ends.filter("__min = __max").select(*group_by, F.lit(1).cast("bigint").alias("n_distinct"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    """Groups whose share of non-NULL values lies outside the bounds."""
    share = F.count(column) / F.nullif(_count(), F.lit(0))
    shares = df.groupBy(*group_by).agg(share.alias("not_null_proportion"))
    return shares.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    now: datetime,
    ignore_time: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest value is older than ``interval`` date parts before ``now``."""
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), moment)
    kind = "date" if ignore_time else "timestamp_ntz"
    newest = df.groupBy(*group_by).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold.cast(kind)).filter("most_recent < threshold")


# --- keys -----------------------------------------------------------------------


def relationships_where(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    field: str,
    from_condition: str = "1 = 1",
    to_condition: str = "1 = 1",
) -> DataFrame:
    """Child rows whose key no parent row has; both sides filtered first.

    Keys of both sides collapse before they shuffle, so one that repeats, in the child
    as in the parent, costs little; orphans are repeated as often as they occur.
    """
    rows = child.filter(F.expr(from_condition) & F.col(column).isNotNull())
    keys = rows.groupBy(F.col(column).alias("id")).agg(_count().alias("__n"))
    known = parent.filter(F.expr(to_condition) & F.col(field).isNotNull()).select(F.col(field).alias("right_id")).distinct()
    lost = repeat_rows(keys.join(known, F.col("id") == F.col("right_id"), "left_anti"), "__n")
    return lost.withColumn("right_id", F.lit(None).cast(parent.schema[field].dataType))


def orphan_count(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """One row: how many child rows ``relationships`` would give.

    Keys collapse to counts before the join, so a hot key is one row of it.
    """
    keys = child.groupBy(F.col(column).alias("id")).agg(_count().alias("n")).filter("id IS NOT NULL")
    known = parent.select(F.col(field).alias("known")).distinct()
    lost = keys.join(known, F.col("id") == F.col("known"), "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_rows"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return relationships_where(child, column, parent, field).select(F.col("id").alias("from_field"))


# --- order ----------------------------------------------------------------------


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows whose value is not the previous value plus the interval.

    Equal values collapse first and carry their count: all copies but one have
    their own value before them.
    """
    groups, previous = list(group_by), f"previous_{slugify(column)}"
    distinct = df.filter(F.col(column).isNotNull()).groupBy(*groups, column).agg(_count().alias("__n"))
    before = with_neighbour(distinct, groups, [column], F.struct(column), "__before", -1, rows_per_task, df.count())

    def broken(prior: Column) -> Column:
        if datepart is None:
            return ~(F.col(column) == prior + interval)
        after = F.timestamp_add(datepart.upper(), F.lit(interval), prior.cast("timestamp_ntz"))
        return ~(F.col(column).cast("timestamp_ntz") == after)

    prior = F.col("__before")[column]
    firsts = before.filter(broken(prior)).select(*groups, column, prior.alias(previous))
    if interval == 0:
        return firsts
    copies = distinct.filter("__n > 1").select(
        *groups, column, F.col(column).alias(previous), (F.col("__n") - 1).alias("__n")
    )
    return firsts.unionByName(repeat_rows(copies, "__n"))


# What may lie between the end of a range and the start of the next one.
GAPS = {"not_allowed": ["touch"], "allowed": ["gap", "touch"], "required": ["gap"]}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_allowed: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Ranges that are wrong in themselves, or do not stand to the next one as ``gaps`` says.

    ``shape`` names what is wrong with the range: ``open`` (a bound is missing), ``reversed``
    or ``empty``. ``meets_next`` names what lies between it and the next range, ``gap``,
    ``touch``, ``overlap`` or ``unknown`` (a bound is missing), where that is not allowed.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {list(GAPS)}, got {gaps!r}")
    keys = ["partition_by_col"] if partition_by else []
    columns = {"lower_bound": lower, "upper_bound": upper}
    if partition_by:
        columns = {"partition_by_col": partition_by, **columns}
    distinct = (
        df.select(*[F.expr(e).alias(name) for name, e in columns.items()]).groupBy(*columns).agg(_count().alias("__n"))
    )
    nexts = with_neighbour(
        distinct, keys, ["lower_bound", "upper_bound"], F.struct("lower_bound"), "__next", 1, rows_per_task, df.count()
    )
    start, end = F.col("lower_bound"), F.col("upper_bound")

    def faults(rows: DataFrame, following: Column) -> DataFrame:
        """``following`` is a struct with the next start, NULL after the last range."""
        after = following["lower_bound"]
        shape = F.when(start.isNull() | end.isNull(), "open").when(end < start, "reversed")
        if not zero_length_allowed:
            shape = shape.when(end == start, "empty")
        meets = F.when(end < after, "gap").when(end == after, "touch").when(end > after, "overlap").otherwise("unknown")
        wrong = F.when(following.isNotNull() & ~meets.isin(GAPS[gaps]), meets)
        judged = rows.withColumns({"next_lower_bound": after, "shape": shape, "meets_next": wrong})
        return judged.filter(F.col("shape").isNotNull() | F.col("meets_next").isNotNull()).drop("__next")

    # the last copy of a range meets the next range, every other copy meets itself
    lasts = faults(nexts.drop("__n"), F.col("__next"))
    copies = distinct.filter("__n > 1").withColumn("__n", F.col("__n") - 1)
    return lasts.unionByName(repeat_rows(faults(copies, F.struct("lower_bound")), "__n"))
