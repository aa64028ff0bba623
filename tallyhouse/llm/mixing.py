"""Mixing sources to target weights by weighted pivotal rounding.

A source's target is its share of all words, by weight, but at most ``cap`` times its
own size; what is cut off is shared again among the others. Every document of a source
starts with the same number of copies, target / size; the whole part is certain, the
fraction is rounded so that the source's words stay as they were: two documents with
fractional copies meet, one gives words to the other until one of the two is whole,
and which way it goes is drawn so that nobody's expected copies change. The one that is
still fractional goes on to the next. Each block of a source leaves one such document;
these meet again in blocks of blocks, until one is left, which goes to the nearer side.
A source's words thus miss its target by half a document at most.

Draws come from hashes of the ids, blocks from hashes too: a rerun takes the same words.

Defined results: a null text has size 0 and words of size 0 take part without weight.
Null is a source of its own, the last. Rows that agree in id, source and size are drawn
together. Empty input gives no rows; when there are no words at all, every target is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents, union_all

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK_ROWS = 512
FAN_IN = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (source, source_size, units) with target.

    Raise the level of words per weight until the budget is spent; a source is full
    at cap * size / weight. In the order of fullness, those before the first source
    that the rest of the budget cannot fill are full.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("position") % len(weights) + 1)
    full = F.col("source_size") * cap
    by_fullness = W.orderBy("fullness", "position")
    before, onward = by_fullness.rowsBetween(W.unboundedPreceding, -1), by_fullness.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum(full).over(before), F.lit(0.0))
    return (
        sources.withColumn("position", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", weight)
        .withColumn("fullness", full / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("level", left / F.sum("weight").over(onward))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("fullness"), F.struct("fullness", "position", "level"))).over(everything)["level"])
        .withColumn("target", F.least(full, F.coalesce(F.col("level") * F.col("weight"), full)))
        .drop("position", "weight", "fullness", "budget", "level")
    )


def pivot(size: np.ndarray, p: np.ndarray, luck: np.ndarray) -> tuple[np.ndarray, int]:
    """Copies after rounding (fractions 0 <= p < 1 become 0 or 1), and the index that stays fractional, or -1.

    The one left has its fraction in the result.
    """
    p = p.astype(float).tolist()
    out = np.zeros(len(p))
    held = -1
    for i, (w, u) in enumerate(zip(size.tolist(), luck.tolist(), strict=True)):
        if p[i] <= 0 or w <= 0:
            out[i] = float(u < p[i])
            continue
        if held < 0:
            held = i
            continue
        v = size[held]
        up, down = min(v * (1 - p[held]), w * p[i]), min(v * p[held], w * (1 - p[i]))
        if u * (up + down) < down:  # the held one gains
            moved = up
            whole = held if v * (1 - p[held]) <= w * p[i] else i
        else:
            moved = -down
            whole = held if v * p[held] <= w * (1 - p[i]) else i
        p[held] = min(1.0, max(0.0, p[held] + moved / v))
        p[i] = min(1.0, max(0.0, p[i] - moved / w))
        out[whole] = float(round(p[whole]))
        held = i if whole == held else held
        if p[held] in (0.0, 1.0):
            out[held], held = p[held], -1
    if held >= 0:
        out[held] = p[held]
    return out, held


def round_blocks(rows: DataFrame) -> DataFrame:
    """One reduction step: each (source, block) keeps at most one document with open = true."""

    def step(table: pa.Table) -> pa.Table:
        table = table.sort_by([("mass", "descending"), ("luck", "ascending")])
        copies, held = pivot(*(table.column(c).to_numpy() for c in ("mass", "p", "luck")))
        is_open = np.arange(len(copies)) == held
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(copies)).set_column(
            table.schema.get_field_index("open"), "open", pa.array(is_open)
        )

    return rows.groupBy("source_no", "block").applyInArrow(step, rows.schema)


def mix(
    docs: DataFrame,
    doc_id: str,
    source: str,
    size: Column,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies: one row for every row of ``docs``."""
    spark = docs.sparkSession
    stages = Stages(spark)
    units = stages.write(
        "sizes",
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("rows")),
    )
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units"))
    numbered = targets(sources, weights, share, cap).withColumn("source_no", F.xxhash64("source", F.lit(1)))
    sources = stages.write("sources", numbered)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    blocks = F.ceil(F.col("units") / BLOCK_ROWS)
    luck = F.pmod(F.xxhash64("doc_id", "source", "size"), F.lit(1 << 40)) / float(1 << 40)
    drawn = (
        units.join(sources.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")))
        .withColumn("whole", F.floor(copies + 1e-9).cast("int"))
        .select(
            "doc_id", "source", "size", "rows", "source_size", "target", "source_no", "whole",
            (F.col("size") * F.col("rows")).cast("double").alias("mass"),
            F.greatest(copies - F.col("whole"), F.lit(0.0)).alias("p"),
            luck.alias("luck"),
            F.pmod(F.xxhash64("doc_id", "size", F.lit(2)), blocks).cast("long").alias("block"),
            F.lit(True).alias("open"),
        )
    )
    most = sources.agg(F.max(blocks)).first()[0] or 1
    levels, level = [], 0
    while True:
        rounded = stages.write(f"level{level}", round_blocks(drawn))
        levels.append(rounded.where("NOT open"))
        if most <= 1:
            levels.append(rounded.where("open").withColumn("p", F.round("p")))
            break
        most, level = -(-most // FAN_IN), level + 1
        drawn = (
            rounded.where("open")
            .withColumn("block", F.floor(F.col("block") / FAN_IN).cast("long"))
            .withColumn("luck", F.pmod(F.xxhash64("doc_id", "source", "size", F.lit(level + 2)), F.lit(1 << 40)) / float(1 << 40))
        )
    stages.drop("sizes", "sources")
    return union_all(levels).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + F.col("p").cast("int")).alias("copies"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("row"),
    ).drop("row")


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir), "doc_id", "source", word_count(F.col("text")))
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
