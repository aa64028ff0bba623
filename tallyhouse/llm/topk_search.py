"""Exact top-k inner products by a KD-tree per shard.

Vectors are dealt to shards by a hash of their id. Each shard becomes one KD-tree:
median splits along the widest dimension, a tight box around every node. A query walks
a tree best first: the largest inner product a box allows decides what is opened next,
and a node is left closed when it cannot beat the kth score so far (or, at a tie, holds
no smaller id). A query is first answered in one shard of its own; the kth score found
there starts the search in all other shards. Queries and shards meet in blocks.

Defined results: vectors that are null, or hold a null or a non-finite component, take
no part, nor do rows without an id. Of rows that share an id the smallest vector counts.
Shorter vectors are as if filled up with zeros. Scores are exact; one outside 64 bits
becomes the nearest number inside.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages

K = 10
SCALE = 1024
SHARD_ROWS = 65_536
MIN_SHARDS = 16
QUERY_ROWS = 2_048
LEAF_ROWS = 128
#: Below this all sums are whole numbers a double holds exactly.
EXACT = float(1 << 53)
RESULT = "query_id long, vec_id long, score long"


def take_part(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of floor(SCALE * x), filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), width))
    out[np.arange(width) < lengths[:, None]] = np.floor(SCALE * lists.flatten().to_numpy().astype(float))
    return out


def build_tree(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes in heap order over one array of points: range, box, smallest id."""
    depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF_ROWS))))
    order = np.argsort(ids, kind="stable")
    ids, points = ids[order], points[order]
    starts, ends = np.zeros(2 ** (depth + 1) - 1, np.int64), np.zeros(2 ** (depth + 1) - 1, np.int64)
    ends[0] = len(ids)
    for node in range(2**depth - 1):
        a, b = starts[node], ends[node]
        middle = (a + b) // 2
        if b - a > 1:
            part = points[a:b]
            axis = int((part.max(axis=0) - part.min(axis=0)).argmax()) if part.shape[1] else 0
            if part.shape[1]:
                split = np.argpartition(part[:, axis], middle - a)
                ids[a:b], points[a:b] = ids[a:b][split], part[split]
        starts[2 * node + 1], ends[2 * node + 1] = a, middle
        starts[2 * node + 2], ends[2 * node + 2] = middle, b
    low, high = np.zeros((len(starts), points.shape[1])), np.zeros((len(starts), points.shape[1]))
    least = np.full(len(starts), np.iinfo(np.int64).max)
    for node, (a, b) in enumerate(zip(starts, ends, strict=True)):
        if b > a:
            low[node], high[node], least[node] = points[a:b].min(axis=0), points[a:b].max(axis=0), ids[a:b].min()
    return {"ids": ids, "points": points, "starts": starts, "ends": ends, "low": low, "high": high, "least": least}


def inner(points: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return points @ q
    whole = np.vectorize(int, otypes=[object])
    sums = (whole(points) * whole(q)).sum(axis=1)
    return np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in sums], object)


def search(tree: dict[str, np.ndarray], own: int, q: np.ndarray, k: int, floor: float | None, exact: bool) -> list[tuple[int, int]]:
    """The k best (score, id) of a tree, none below ``floor``."""
    low, high, starts, ends, least = (tree[c] for c in ("low", "high", "starts", "ends", "least"))
    best: list[tuple] = []  # a heap, worst first: (score, -id)
    inner_nodes = len(starts) // 2

    def bound(node: int) -> float:
        return float(np.maximum(low[node] * q, high[node] * q).sum())

    def closed(top: float, node: int) -> bool:
        if not exact:
            top += abs(top) * 1e-12 + 1  # the bound is rounded there
        if floor is not None and top < floor:
            return True
        return len(best) == k and (top < best[0][0] or (top == best[0][0] and least[node] > -best[0][1]))

    todo = [(-bound(0), 0)] if ends[0] else []
    while todo:
        top, node = heapq.heappop(todo)
        if closed(-top, node):
            continue
        if node < inner_nodes:
            for child in (2 * node + 1, 2 * node + 2):
                if ends[child] > starts[child] and not closed(b := bound(child), child):
                    heapq.heappush(todo, (-b, child))
            continue
        a, b = starts[node], ends[node]
        scores, ids = inner(tree["points"][a:b], q, exact), tree["ids"][a:b]
        least_score = max([x for x in (floor, best[0][0] if len(best) == k else None) if x is not None], default=None)
        wanted = ids != own if least_score is None else (ids != own) & (scores >= least_score)
        for s, i in zip(scores[wanted].tolist(), ids[wanted].tolist(), strict=True):
            entry = (int(s), -i)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(s, -i) for s, i in best]


def top_k(vectors: DataFrame, vec_id: str, vector: str, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``is_query`` its k best among all other rows."""
    spark = vectors.sparkSession
    stages = Stages(spark)
    rows = stages.write(
        "vectors",
        vectors.where(F.col(vec_id).isNotNull() & take_part(F.col(vector)))
        .groupBy(F.col(vec_id).cast("long").alias("vec_id"))
        .agg(F.min(vector).alias("vector"))
        .withColumn("is_query", F.coalesce(is_query, F.lit(False))),
    )
    largest = F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    n, asked, width, peak = rows.agg(F.count("*"), F.count_if("is_query"), F.max(F.size("vector")), largest).first()
    width, exact = width or 0, ((peak or 0.0) * SCALE + 1) ** 2 * (width or 1) < EXACT
    shards = max(MIN_SHARDS, -(-n // SHARD_ROWS))
    blocks = max(1, -(-asked // QUERY_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int")

    def build(key: tuple, table: pa.Table) -> pa.Table:
        tree = build_tree(table.column("vec_id").to_numpy().copy(), matrix(table.column("vector"), width))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32())} | {c: [a.tobytes()] for c, a in tree.items()})

    def answer(trees: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if trees.num_rows and queries.num_rows:
            row = trees.to_pylist()[0]
            tree = {c: np.frombuffer(row[c], np.int64 if c in ("ids", "starts", "ends", "least") else float) for c in parts}
            tree |= {c: tree[c].reshape(-1, width) if width else np.zeros((max(len(tree["starts"]), len(tree["ids"])), 0)) for c in ("points", "low", "high")}
            asked = matrix(queries.column("vector"), width)
            for own, q, floor in zip(queries.column("vec_id").to_pylist(), asked, queries.column("floor").to_pylist(), strict=True):
                found += [(own, i, s) for s, i in search(tree, own, q, k, floor, exact)]
        return pa.table({c: pa.array([f[j] for f in found], pa.int64()) for j, c in enumerate(("query_id", "vec_id", "score"))})

    parts = ["ids", "points", "starts", "ends", "low", "high", "least"]
    trees = stages.write(
        "trees",
        rows.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard int, " + ", ".join(f"{c} binary" for c in parts)),
    )
    queries = rows.where("is_query").select(
        "vec_id", "vector", shard.alias("home"), F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int").alias("block")
    )
    in_blocks = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("shard", "block")
    at_home = queries.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("double"))
    near = stages.write("home", in_blocks.cogroup(at_home.groupBy("shard", "block")).applyInArrow(answer, RESULT))
    floors = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    elsewhere = (
        queries.join(floors, F.col("vec_id") == F.col("query_id"), "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .where("shard <> home")
    )
    far = in_blocks.cogroup(elsewhere.groupBy("shard", "block")).applyInArrow(answer, RESULT)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.unionByName(far).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


@query("op5_topk_search", SQL)
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0)
