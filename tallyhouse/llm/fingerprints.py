"""Document fingerprints from closed syncmers, in column expressions only.

Words are runs without white space (longer ones in parts of 32 characters). A k-mer is
K words in a row; its inner substrings are the S-word strings in it. A k-mer is an
anchor when the smallest hash of its inner substrings is the first's or the last's:
that looks at nothing but the k-mer, so an edit moves no anchor outside the k-mers it
touches. The fingerprint lists the anchors' hashes in text order, each once; likeness is
the share of hashes two fingerprints have in common.

Defined results: a null text is an empty one, with an empty fingerprint; two empty
fingerprints are alike (1), an empty and another one are not (0). A text of fewer than
K words, or without an anchor, is listed word by word. Of documents with one id the order is by a hash of the
text; the document after the last is the first, so a lone document follows itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents

WORD = r"\S{1,32}"
K, S = 5, 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hash31(*columns: Column) -> Column:
    return F.xxhash64(*columns).bitwiseAND(0x7FFFFFFF).cast("int")


def at(array: Column, i: Column, shift: int) -> Column:
    return F.get(array, i + shift if shift else i)


def fingerprint(text: Column, k: int = K, s: int = S) -> Column:
    """Hashes of the closed syncmers in text order, as an array of int."""

    def anchors(words: Column) -> Column:
        def of(inner: Column) -> Column:
            def anchor(i: Column) -> Column:
                edge = F.least(at(inner, i, 0), at(inner, i, k - s))
                middle = F.least(*(at(inner, i, j) for j in range(1, k - s)), edge)
                name = hash31(*(at(inner, i, j) for j in (*range(0, k - s, s), k - s)))
                return F.when(edge <= middle, name)

            return F.array_compact(F.transform(F.sequence(F.lit(0), F.size(words) - k), anchor))

        inner = F.transform(F.sequence(F.lit(0), F.size(words) - s), lambda i: F.xxhash64(*(at(words, i, j) for j in range(s))))
        found = F.when(F.size(words) < k, F.array().cast("array<int>")).otherwise(let(inner, of))
        return let(found, lambda a: F.when(F.size(a) > 0, a).otherwise(F.transform(words, lambda w: hash31(w))))

    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    return F.array_distinct(let(words, anchors))


def spelled(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, 1.0).otherwise(shared / either)


def with_next(docs: DataFrame, runs: int) -> DataFrame:
    """``docs`` (doc_id, text, anchors) with next_text and next_anchors.

    The order of ids is cut into runs, found on ids alone; each run is given the first
    row of the run after it, so the neighbour is a look ahead within a run.
    """
    stages = Stages(docs.sparkSession)
    ids = docs.select("doc_id", "tie")
    cut = stages.write("ids", ids.repartitionByRange(runs, "doc_id", "tie").groupBy(F.spark_partition_id().alias("run")).agg(F.min(F.struct("doc_id", "tie")).alias("head")))
    # one row for each run
    heads = [r["head"] for r in cut.orderBy("head").collect()]
    if not heads:
        return docs.withColumns({"next_text": F.col("text"), "next_anchors": F.col("anchors")})
    bounds = F.array(*(F.struct(F.lit(h["doc_id"]).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(h["tie"]).alias("tie")) for h in heads))
    me = F.struct("doc_id", "tie")
    run = F.size(F.filter(bounds, lambda b: b <= me)) - 1
    placed = docs.withColumns({"run": run, "extra": F.lit(0)})
    first = placed.where(F.array_contains(bounds, me)).withColumns({"run": F.pmod(F.col("run") - 1, F.lit(len(heads))), "extra": F.lit(1)})
    order = W.partitionBy("run").orderBy("extra", "doc_id", "tie")
    ahead = placed.unionByName(first).withColumns({"next_text": F.lead("text").over(order), "next_anchors": F.lead("anchors").over(order)})
    return ahead.where("extra = 0").drop("run", "extra")


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", text.alias("text")).withColumn("tie", F.xxhash64("text"))
    docs = docs.withColumn("anchors", fingerprint(F.col("text")))
    rows = with_next(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_anchors", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spelled(F.col("anchors")).alias("fingerprint"),
        spelled(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
