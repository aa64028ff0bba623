"""Reshaping tables: deduplicate, pivot, unpivot, union by name, project, null out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.raw import union_all


def _lower(names: Sequence[str] | None) -> set[str]:
    return {n.lower() for n in names or []}


def slugify(text: str) -> str:
    """Lower-case name of letters, digits and underscores, not starting with a digit."""
    slug = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", text.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order.

    Spark keeps one candidate per key and task before the shuffle, so a hot key
    costs one row per task. Give sort columns with their NULL placement; plain names
    sort ascending with NULLs last. With ties, any of the tied rows may be kept.
    """
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


# The comparisons a pivot accepts.
COMPARISONS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}


def _over_distinct(agg: str, value: Column) -> Column:
    """``agg`` over the distinct values of a group."""
    if agg in ("min", "max"):  # the same with and without repeats
        return getattr(F, agg)(value)
    if agg in ("avg", "mean"):
        return F.sum_distinct(value) / F.nullif(F.count_distinct(value), F.lit(0))
    known = {"sum": F.sum_distinct, "count": F.count_distinct}
    if agg not in known:
        raise ValueError(f"no distinct form of {agg}; there are avg, count, max, mean, min and sum")
    return known[agg](value)


def pivot(
    column: str,
    values: Sequence[Any],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | Any = 1,
    else_value: Column | Any = 0,
    distinct: bool = False,
    slugs: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for use in ``groupBy(...).agg(*...)``.

    All values share one scan and one shuffle, and combine map-side.
    """

    def value_of(x: Column | Any) -> Column:
        return x if isinstance(x, Column) else F.lit(x)

    out = []
    for value in values:
        hit = COMPARISONS[cmp](F.col(column), F.lit(value))
        picked = F.when(hit, value_of(then_value)).otherwise(value_of(else_value))
        if distinct:
            result = _over_distinct(agg, picked)
        else:
            result = getattr(F, agg)(picked)
        name = f"{prefix}{value}{suffix}"
        out.append(result.alias(slugify(name) if slugs else name))
    return out


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] | None = None,
    remove: Sequence[str] | None = None,
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one scan; NULL values stay, booleans become true/false."""
    keep, gone = _lower(exclude), _lower(remove)
    ids = [c for c in df.columns if c.lower() in keep]
    melted = [c for c in df.columns if c.lower() not in keep | gone]
    kind = T._parse_datatype_string(cast_to)

    def as_value(c: str) -> Column:
        # through text for booleans, as 'true' and 'false'
        boolean = isinstance(df.schema[c].dataType, T.BooleanType)
        return (F.col(c).cast("string") if boolean else F.col(c)).cast(kind).alias(c)

    return df.select(*ids, *[as_value(c) for c in melted]).unpivot(ids, melted, field_name, value_name)


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    source_column: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """UNION ALL by column name, with missing columns NULL and the table's name.

    A column takes the name and type it has in the first table that has it, unless the
    type is overridden. Names are compared without case. ``where`` filters every table before the union.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = {c.lower(): kind for c, kind in (column_override or {}).items()}
    names: dict[str, str] = {}
    kinds: dict[str, Any] = {}
    for df in relations.values():
        for field in df.schema.fields:
            low = field.name.lower()
            wanted = low in _lower(include) if include else low not in _lower(exclude)
            if wanted:
                names.setdefault(low, field.name)
                kinds.setdefault(low, override.get(low, field.dataType))
    if not kinds:
        raise ValueError(f"no columns left to union for {list(relations)}")

    def shaped(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        tag = [F.lit(name).alias(source_column)] if source_column else []
        own = {c.lower(): c for c in df.columns}
        return rows.select(
            *tag,
            *[(F.col(f"`{own[low]}`") if low in own else F.lit(None)).cast(kind).alias(names[low]) for low, kind in kinds.items()],
        )

    return union_all([shaped(name, df) for name, df in relations.items()])


def tables_like(spark: SparkSession, schema: str, pattern: str, exclude: str = "") -> list[str]:
    """Names of tables and views matching a case-blind ``%``/``_`` pattern."""

    def matcher(sql_pattern: str) -> re.Pattern[str]:
        parts = {"%": ".*", "_": "."}
        return re.compile("".join(parts.get(ch, re.escape(ch)) for ch in sql_pattern), re.IGNORECASE | re.DOTALL)

    names = sorted({t.name for t in spark.catalog.listTables(schema)})
    wanted, unwanted = matcher(pattern), matcher(exclude)
    return [n for n in names if wanted.fullmatch(n) and not unwanted.fullmatch(n)]


def union_by_pattern(
    spark: SparkSession, schema: str, pattern: str, exclude: str = "", **options: Any
) -> DataFrame:
    """``union_relations`` over every table whose name matches."""
    names = tables_like(spark, schema, pattern, exclude)
    if not names:
        raise ValueError(f"no table in {schema} matches {pattern}")
    return union_relations({n: spark.table(n) for n in names}, **options)


def union_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "", **options: Any) -> DataFrame:
    return union_by_pattern(spark, schema, f"{prefix}%", exclude, **options)


def star(df: DataFrame, except_: Sequence[str] | None = None, prefix: str = "", suffix: str = "", relation_alias: str = "") -> list[Column]:
    """All columns but some (names compared without case), optionally renamed.

    ``relation_alias`` is the alias ``df`` has in a join, where its names alone may be ambiguous.
    """
    gone = _lower(except_)
    of = f"`{relation_alias}`." if relation_alias else ""
    return [F.col(f"{of}`{c}`").alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in gone]


def group_by_first(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def nullcheck(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The given columns with '' as NULL where they are text."""
    return [
        F.nullif(F.col(c), F.lit("")).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        for c in columns
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df, df.columns))


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values with their counts, the most frequent first.

    ``order_by`` may use ``value`` and ``n``. ``max_records`` makes it a top-k.
    """
    rows = df.filter(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(*(order_by or [F.col("n").desc(), F.col("value").asc_nulls_last()]))
    return ordered if max_records is None else ordered.limit(max_records)


#: Values that may come to the driver when no other bound is given.
MOST_VALUES = 100_000


def value_list(df: DataFrame, column: str, max_records: int = MOST_VALUES, default: list | None = None, **options: Any) -> list:
    """All values, for ``pivot``. They come to the driver, so more than ``max_records`` of them raise."""
    rows = column_values(df, column, max_records=max_records + 1, **options).collect()
    if len(rows) > max_records:
        raise ValueError(f"{column} has more than {max_records} values")
    return [r["value"] for r in rows] or (default or [])


def single_value(df: DataFrame, default: Any = None) -> Column:
    """First cell of a query as a scalar subquery; ``default`` when it has no rows."""
    # by position, as a computed column's name need not be a valid reference
    one = df.toDF("v", *[f"other_{i}" for i in range(1, len(df.columns))]).select("v").limit(1)
    picked = one.agg(F.when(F.count(F.lit(1)) == 0, F.lit(default)).otherwise(F.first("v")).alias("v"))
    return picked.scalar()
