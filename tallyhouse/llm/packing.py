"""Packing token pieces into sequences by best-two-fit.

A sequence is filled greedily with the longest piece that still fits. Then its
smallest piece goes back if two unpacked pieces fit the wider gap more tightly, for as
long as that helps.

Which document a piece comes from does not matter to that rule, only its length, and
there are ``capacity`` lengths at most. So one count per length is planned on the
driver: the rule yields a pattern of lengths, which holds for as many sequences as the
counts allow, and all of those are filled at once. Spark then ranks the pieces of each
length (in hashed blocks, so a length many copies share is split) and looks up which
sequence and offset a rank belongs to.

Defined results: a null text is an empty one, and an empty document is the closing
token alone. Documents that repeat an id are packed one by one. Empty input gives no
rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents

CAPACITY = 2048
CLOSING_ID = 0
VOCABULARY = "byte_bpe_50k"
BLOCK_ROWS = 50_000
MIN_BLOCKS = 64
_RANKS = 40  # bits of a rank within a length


class Encoder:
    """Ids of the ``tokenizers`` file, by the quicker of two libraries with one vocabulary.

    Texts that hold the spelling of a special token go through the file itself, the
    others through its ranks; the ids are the same.
    """

    def __init__(self, name: str = VOCABULARY) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.file = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [t.content for t in self.file.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.file.encode(text, add_special_tokens=False).ids
        return self.ranks.encode_ordinary(text)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of each piece of n ids; only the first may be shorter than the others."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def token_pieces(docs: DataFrame, doc_id: str, text: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of every piece."""
    schema = f"doc_id {dict(docs.dtypes)[doc_id]}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows, ids = [], []
                for i, value in enumerate(part.column("text")):
                    tokens = np.array([*encoder.ids(value.as_py() or ""), CLOSING_ID], "<u4")
                    for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                        piece = tokens[start : start + length]
                        rows.append((i, k, start, length, zlib.crc32(piece.tobytes())))
                        if with_ids:
                            ids.append(piece.astype(np.int32))
                of, piece, start, length, crc = np.array(rows, np.int64).T
                columns = [part.column("doc_id").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, schema)


def best_pair(lengths: np.ndarray, twice: np.ndarray, room: int) -> tuple[int, int] | None:
    """Of the sorted available lengths the two that fill ``room`` best; ``twice`` tells which are there twice."""
    partner = np.searchsorted(lengths, room - lengths, side="right") - 1
    own = np.arange(len(lengths))
    partner = np.where((partner == own) & ~twice, partner - 1, partner)
    total = np.where(partner >= 0, lengths + lengths[partner], 0)
    best = int(total.argmax())
    return (int(lengths[best]), int(lengths[partner[best]])) if total[best] else None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> how many) and the number of sequences filled with each."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while left.any():
        free = left.copy()
        lengths = np.flatnonzero(free)
        held = [int(lengths[-1])]
        free[held[0]] -= 1
        gap = capacity - held[0]
        while gap and len(fits := np.flatnonzero(free[: gap + 1])):
            held.append(int(fits[-1]))
            free[held[-1]] -= 1
            gap -= held[-1]
        while gap and len(held) > 1:
            smallest = min(held)
            lengths = np.flatnonzero(free[: gap + smallest + 1])
            pair = best_pair(lengths, free[lengths] > 1, gap + smallest) if len(lengths) else None
            if pair is None or sum(pair) <= smallest:
                break
            held.remove(smallest)
            free[smallest] += 1
            for length in pair:
                held.append(length)
                free[length] -= 1
            gap += smallest - sum(pair)
        pattern = {length: held.count(length) for length in sorted(set(held), reverse=True)}
        times = min(int(left[length]) // n for length, n in pattern.items())
        for length, n in pattern.items():
            left[length] -= n * times
        patterns.append((pattern, times))
    return patterns


def segments(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (first length and rank, pieces per sequence, first sequence, first offset), sorted."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, n in pattern.items():
            rank = used.get(length, 0)
            rows.append(((length << _RANKS) + rank, n, sequence, offset))
            used[length] = rank + n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written; doc_id, piece, length and more) with sequence_id and offset."""
    total = pieces.count()
    blocks = max(MIN_BLOCKS, -(-total // BLOCK_ROWS))
    blocked = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    sizes = blocked.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("length", "block", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "block").orderBy("doc_id", "piece"))
    ranked = blocked.withColumn("rank", within).join(starts, ["length", "block"]).withColumn("rank", F.col("rank") - 1 + F.col("before"))
    # as many rows as there are lengths
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = segments(plan(counts, capacity))
    names = pieces.columns

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            key = (length << _RANKS) + rank
            first, n, sequence, offset = table[np.searchsorted(table[:, 0], key, side="right") - 1].T
            nth, slot = np.divmod(key - first, n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence + nth), pa.array(offset + slot * length)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*names, "rank").mapInArrow(look_up, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, doc_id: str, text: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset."""
    stages = Stages(docs.sparkSession)
    return place(stages.write("pieces", token_pieces(docs, doc_id, text, capacity, with_ids)), capacity)


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), "doc_id", "text", with_ids=False)
