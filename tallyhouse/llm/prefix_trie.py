"""Prefix trie of conversations by a skeleton of range splitters.

A turn becomes the SHA-256 of its role and text, a conversation the list of these, its
path. Paths are dealt to shards in their sorted order, equal ones by id, so that the
members of a node lie side by side. A node reaches beyond its shard only if it is a start
of a path at which a range begins: such nodes form the skeleton, the trie of the splitter
paths. A shard knows its own first and last path, so the depth at which each splitter
parts from the row before it describes the whole skeleton; this table, two numbers a
shard, goes to all tasks. A shard finishes every other node by itself: a stack opens its
nodes, a backward pass adds children to parents. Of a skeleton node it gives its share;
shares are summed by key, and one sorted pass over the skeleton alone, at most
shards x depth rows, adds its subtrees.

The members that end in one node are hashed in order. Shards join their ids to short
lists; where the node is in the skeleton, one task streams the lists of its shards, in
bounded memory, as a digest of a sequence cannot be divided.

Defined results: null roles and texts are empty. Rows without a conv_id are left out.
Turns of equal number follow by role, then by digest; repeated rows are turns of their
own. An empty table has no nodes, not even the root. A conversation is held whole as its
path, 40 bytes a turn; its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages
from tallyhouse.llm.mixing import WORD, word_count

FAMILY, KEPT = 20, 4
TURNS_PER_SHARD = 200_000
IDS_PER_LIST = 1_000
#: The skeleton is broadcast up to this many rows of some 50 bytes; beyond, it is joined by salted keys.
MOST_BROADCAST, SALTS = 200_000, 64
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
SHARE = f"kind string, key binary, shard int, place int, words long, {NODE}, ends string"
ARROW = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}


def schema_of(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def own_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id and own, its turns in order as (turn, role, digest, words)."""
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256))
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), by.alias("role"), digest.alias("digest"), word_count(said).alias("words")).alias("said"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("own"))


def rebuild(own: DataFrame) -> DataFrame:
    """conv_id, path and words: the first h turns of the family's first conversation, then the own turns after h."""
    base, h = F.col("conv_id") - F.col("conv_id") % FAMILY, (F.crc32(F.col("conv_id").cast("string")) % KEPT).cast("int")
    starts = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, KEPT - 1).alias("start"))
    joined = own.withColumn("base", base).join(starts, "base", "left")
    start = F.coalesce(F.slice("start", F.lit(1), h), F.slice("own", 1, 0))
    rest = F.slice("own", h + 1, F.size("own"))
    turns = joined.select("conv_id", F.concat(start, rest).alias("turns"))
    return turns.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))


def common_start(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays agree."""
    agree = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    parted = F.array_position(agree, F.lit(False))
    return F.coalesce(F.when(parted == 0, F.size(agree)).otherwise(parted - 1), F.lit(0)).cast("int")


def crossings(paths: DataFrame) -> dict[int, tuple[int, int]]:
    """For each shard, how deep its first path agrees with the row before it, its last with the row after it."""
    edges = paths.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = W.orderBy("shard")
    after = F.lead("first").over(order)
    edges = edges.select("shard", common_start(F.lag("last").over(order), F.col("first")).alias("left"), common_start(F.col("last"), after).alias("right"))
    return {r["shard"]: (r["left"], r["right"]) for r in edges.collect()}


def shard_nodes(shard: int, rows: pa.Table, left: int, right: int) -> list[tuple]:
    """Finished nodes of a sorted shard, its shares of skeleton nodes, and lists of ids that end in those."""
    rows = rows.sort_by("place")
    parent, depth, turn, counts, ends = [-1], [0], [b""], [0], [[]]
    stack, before, skeleton = [0], [], {0}
    for i, (conv, path, words) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("conv_id", "path", "words")), strict=True)):
        common = next((d for d, (a, b) in enumerate(zip(before, path)) if a != b), min(len(before), len(path)))  # noqa: B905
        del stack[common + 1 :]
        for d in range(common, len(path)):
            parent.append(stack[-1])
            depth.append(d + 1)
            turn.append(path[d])
            counts.append(words[d])
            ends.append([])
            stack.append(len(parent) - 1)
        ends[stack[-1]].append(conv)
        before = path
        if i == 0:
            skeleton.update(stack[: left + 1])
    skeleton.update(stack[: right + 1])

    size = len(parent)
    n_convs, children, leaves, saved = [len(e) for e in ends], [0] * size, [0] * size, [0] * size
    least = [e[0] if e else None for e in ends]
    for node in range(size - 1, -1, -1):
        up, local = parent[node], node not in skeleton
        if local:
            leaves[node] = leaves[node] or 1
            saved[node] += (n_convs[node] - 1) * counts[node]
        if up >= 0:
            n_convs[up] += n_convs[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            if local:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
    keys = {0: b""}
    out = []
    for node in range(size):
        up, figures = parent[node], (n_convs[node], children[node], leaves[node], saved[node])
        if node not in skeleton:
            digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
            smallest = None if up in skeleton else least[up]
            out.append(("node", keys.get(up), shard, node, None, least[node], depth[node], smallest, *figures, digest))
            continue
        if up >= 0:
            keys[node] = hashlib.sha256(keys[up] + turn[node]).digest()
        out.append(("share", keys[node], shard, node, counts[node], least[node], depth[node], None, *figures, None))
        for at in range(0, len(ends[node]), IDS_PER_LIST):
            listed = ",".join(map(str, ends[node][at : at + IDS_PER_LIST]))
            out.append(("ends", keys[node], shard, at, None, None, None, None, None, None, None, None, listed))
    return out


def add_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skeleton nodes, parents first, with their shares summed: finish what depends on children."""
    schema = schema_of(f"key binary, {NODE}")
    stack: list[dict] = []

    def close(down_to: int) -> list[tuple]:
        out = []
        while len(stack) > down_to:
            node = stack.pop()
            node["n_leaves"] = node["n_leaves"] or 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node["words"]
            if stack:
                stack[-1]["n_children"] += 1
                stack[-1]["n_leaves"] += node["n_leaves"]
                stack[-1]["saved_tokens"] += node["saved_tokens"]
            out.append(tuple(node[c] for c in schema.names))
        return out

    for batch in batches:
        done = []
        for node in batch.to_pylist():
            done += close(node["depth"])
            stack.append(node | {"parent_conv_id": stack[-1]["conv_id"] if stack else None})
        yield table_of(done, schema)
    yield table_of(close(0), schema)


def hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its lists, which come in order."""
    schema = schema_of("key binary, ends_sha256 string")
    key, digest = None, None
    for batch in batches:
        done = []
        for row_key, ends in zip(batch.column("key").to_pylist(), batch.column("ends"), strict=True):
            if row_key != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = row_key, hashlib.sha256(ends.as_py().encode())
            else:
                digest.update(b"," + ends.as_py().encode())
        yield table_of(done, schema)
    if digest is not None:
        yield table_of([(key, digest.hexdigest())], schema)


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes over ``conversations`` (conv_id, path, words), with their figures and ends_sha256."""
    spark = conversations.sparkSession
    stages = Stages(spark)
    rows = stages.write("paths", conversations)
    turns = rows.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-turns // TURNS_PER_SHARD))
    ranged = rows.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_rows = stages.write("sorted", ranged.select("*", F.spark_partition_id().alias("shard"), place.alias("place")))
    stages.drop("paths")
    depths = crossings(sorted_rows)
    share_schema = schema_of(SHARE)

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        return pa.Table.from_batches([table_of(shard_nodes(shard, table, *depths[shard]), share_schema)])

    found = stages.write("nodes", sorted_rows.groupBy("shard").applyInArrow(finish, SHARE))
    stages.drop("sorted")
    shares = (
        found.where("kind = 'share'")
        .groupBy("key")
        .agg(
            F.min("shard").alias("shard"),
            *[F.min(c).alias(c) for c in ("depth", "words", "conv_id")],
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
    )
    # a node first seen in a later shard, or deeper in the same, comes after its parent
    ordered = shares.repartition(1).sortWithinPartitions("shard", "depth").drop("shard")
    lists = found.where("kind = 'ends'").select("key", "shard", "place", "ends").repartition("key").sortWithinPartitions("key", "shard", "place")
    hashed = lists.mapInArrow(hash_lists, "key binary, ends_sha256 string")
    skeleton = stages.write(
        "skeleton",
        ordered.mapInArrow(add_subtrees, f"key binary, {NODE}")
        .join(hashed, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))),
    )
    columns = [c.split()[0] for c in NODE.split(", ")]
    inside = found.where("kind = 'node'").select("key", *columns, F.col("ends").alias("ends_sha256"))
    parents = skeleton.select("key", F.col("conv_id").alias("above"))
    if parents.count() <= MOST_BROADCAST:
        below = inside.where("key IS NOT NULL").join(F.broadcast(parents), "key")
    else:
        salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        below = inside.where("key IS NOT NULL").withColumn("salt", F.pmod("conv_id", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"]).drop("salt")
    below = below.withColumn("parent_conv_id", F.col("above")).drop("above")
    return inside.where("key IS NULL").unionByName(below).unionByName(skeleton).drop("key")


# reflected CRC-32 of the decimal id, bit by bit
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
  lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""

SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT conv_id, turn, role, sha256(length(role) || ':' || role || text) AS digest, len(regexp_extract_all(text, '{WORD}')) AS words FROM t
), o AS (
  SELECT conv_id, list(struct_pack(digest := digest, words := words) ORDER BY turn NULLS FIRST, role, digest) AS own,
         CAST({_CRC} AS BIGINT) % {KEPT} AS h
  FROM s GROUP BY conv_id
), r AS (
  SELECT o.conv_id, list_concat(CASE WHEN b.own IS NULL THEN [] ELSE b.own[1:o.h] END, o.own[o.h + 1:]) AS turns
  FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % {FAMILY}
), p AS (SELECT conv_id, turns, array_to_string(list_transform(turns, lambda x: x.digest), '') AS path FROM r
), m AS (
  SELECT conv_id, d AS depth, substr(path, 1, 64 * d) AS node, CASE WHEN d = 0 THEN 0 ELSE turns[d].words END AS words, d = len(turns) AS ends
  FROM p, range(0, len(turns) + 1) AS x(d)
), n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY node, depth
), k AS (SELECT substr(node, 1, 64 * (depth - 1)) AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
), f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)
), u AS (
  SELECT substr(node, 1, 64 * a) AS node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM f, range(0, depth + 1) AS x(a) GROUP BY ALL
)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN u USING (node) LEFT JOIN f q ON f.depth > 0 AND q.node = substr(f.node, 1, 64 * (f.depth - 1))
"""


@query("op11_prefix_trie", SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    stages = Stages(spark)
    own = stages.write("own", own_turns(conversations, "conv_id", "turn", "role", "text"))
    return trie(rebuild(own))
