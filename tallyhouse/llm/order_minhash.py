"""Near-duplicate documents by order MinHash.

A text is its words, in lower case. Its k-mers are k words in a row, each labelled with
how often it has occurred before. For each of several hash functions the ORDER smallest
labelled k-mers are taken and put back in text order; the sequence is one sketch value.
SKETCHES has the lengths k and their numbers of hash functions: long k-mers are seldom
shared by chance, short ones outlive scattered edits. README has the recall.
Two texts agree in a sketch the more often the more k-mers they share in the same order,
which follows edit similarity. Texts that agree in a sketch value are candidates; a
banded alignment of their words verifies that at most 1 - SIMILARITY of the longer text's
words are edited. Linked texts and their links' links are one class.

Equal texts are one from the start: only one of them is sketched and compared.

Ids are whole numbers; a text id fails the job.

Defined results: a null text is an empty one; texts without words are equal to each
other. A text of fewer than k words is one k-mer. Rows without an id are left out, rows
that repeat an id and its text count once; if one id has several texts, each takes part.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents
from tallyhouse.llm.linking import VALUES, candidate_pairs, classes_of, in_blocks, in_slices

SIMILARITY = 0.8
SKETCHES = {5: 24, 3: 24}
#: Sketch values whose buckets are looked through at once, which bounds the disk they take.
AT_ONCE = 24
ORDER = 2
HELD_WORDS = 1_000_000
#: Cells of the k-mer by hash function matrix that are held at once.
CELLS = 4_000_000
#: Bits of the marks that tell texts apart by their labelled words.
MARKS = 3072
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Word -> 64-bit hash; forgets when it has grown."""

    def __missing__(self, word: str) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def hashes(words: list[str], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MORE
    return x ^ (x >> np.uint64(29))


def labelled_kmers(words: np.ndarray, k: int, plain: bool = False) -> np.ndarray:
    """Hash of every k-mer and its number among equal ones before it.

    In a text that repeats a k-mer all have other hashes than in one that repeats none,
    unless the first of equal ones is left ``plain``.
    """
    k = min(k, len(words))
    n = len(words) - k + 1
    kmers = np.zeros(n, np.uint64)
    for i in range(k):
        kmers = (kmers + words[i : i + n]) * _MIX
    kmers = mixed(kmers)
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    if same.any():
        place = np.arange(n)
        first = np.maximum.accumulate(np.where(same, 0, place))
        label = np.empty(n, np.uint64)
        label[order] = (place - first).astype(np.uint64)
        kmers = np.where(plain & (label == 0), kmers, mixed(kmers + label * _MIX))
    return kmers


def factors_of(number: int, first: int = 1) -> np.ndarray:
    return mixed(np.arange(first, first + number, dtype=np.uint64) * _MIX) | np.uint64(1)


def all_sketches(words: np.ndarray) -> np.ndarray:
    """The values of all SKETCHES; equal places of two texts have the same k-mer length and hash function."""
    firsts = np.cumsum([1, *SKETCHES.values()])
    return np.concatenate([sketches(words, factors_of(n, first), k) for (k, n), first in zip(SKETCHES.items(), firsts.tolist())])


def sketches(words: np.ndarray, factors: np.ndarray, k: int) -> np.ndarray:
    """One value for each factor, from the ORDER smallest labelled k-mers in text order."""
    kmers = labelled_kmers(words, k)
    taken = min(ORDER, len(kmers))
    values = np.empty(len(factors), np.uint64)
    step = max(1, CELLS // len(kmers))
    for at in range(0, len(factors), step):
        table = mixed(kmers[None, :] * factors[at : at + step, None])
        rows = np.arange(len(table))
        places = np.empty((len(table), taken), np.int64)
        for j in range(taken):
            places[:, j] = table.argmin(axis=1)
            table[rows, places[:, j]] = np.iinfo(np.uint64).max
        value = factors[at : at + step].copy()
        for place in np.sort(places, axis=1).T:
            value = mixed(value * _MIX + kmers[place])
        values[at : at + step] = value
    return values


def bag_minima(words: np.ndarray) -> np.ndarray:
    """VALUES minima over a text's words, each labelled with its number among equal ones.

    Texts whose words need few edits have most labelled words in common: two thirds of
    either's at SIMILARITY, and so many minima agree.
    """
    bag, factors = labelled_kmers(words, 1), factors_of(VALUES, sum(SKETCHES.values()) + 1)
    step = max(1, CELLS // len(bag))
    return np.concatenate([mixed(bag[None, :] * factors[at : at + step, None]).min(axis=1) for at in range(0, VALUES, step)])


def bag_marks(words: np.ndarray) -> np.ndarray:
    """MARKS bits, as bytes: each tells whether an odd number of the text's labelled words falls on it."""
    places = (mixed(labelled_kmers(words, 1, plain=True)) % np.uint64(MARKS)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    return np.packbits((np.bincount(places, minlength=MARKS) & 1).astype(bool))


def most_marks(similarity: float, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """In how many ``bag_marks`` two near texts of these numbers of words can differ, or -1 if none are near.

    A word put in or taken out is one labelled word more or less, a replaced one is both.
    Of the edits allowed, as many as the sizes differ by are of the first kind.
    """
    edits, more = np.floor((1 - similarity) * np.maximum(size_a, size_b) + 1e-6), np.abs(size_a - size_b)
    return np.where(more <= edits, 2 * edits - more, -1).astype(np.int64)


def banded_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences, or most + 1 where it is larger.

    Only cells at most ``most`` off the diagonal count. A column of the band is held as
    bits, one for each cell: where it rises and where it falls against the cell above. So
    a column costs a few operations on numbers of 2 * most + 2 bits.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if n - m > most:
        return most + 1
    same = next((i for i in range(m) if a[i] != b[i]), m)
    a, b = a[same:], b[same:]
    while b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    n, m = len(a), len(b)
    if not m:
        return n
    # a band wider than the table is the table
    most, wanted = min(most, n - 1), most
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    width = 2 * most + 2
    mask = (1 << width) - 1
    rises, falls = mask ^ ((1 << (width - most - 1)) - 1), 0
    edge, score, lowest = 1 << (width - 1), most, most + 1 - width
    for j, x in enumerate(b):
        found = places.get(x, 0)
        match = (found >> lowest if lowest >= 0 else found << -lowest) & mask
        level = ((((match & rises) + rises) ^ rises) | match | falls) & mask
        right_up, right_down = falls | (mask ^ (level | rises)), level & rises
        if j < n - most:  # down the lower edge of the band, then along the last row
            score += not level & edge
        else:
            edge >>= 1
            score += bool(right_up & edge) - bool(right_down & edge)
        if score > 2 * most + m - n:
            break
        rises, falls = right_down | (mask ^ ((level >> 1) | right_up)), (level >> 1) & right_up
        lowest += 1
    else:
        if score <= most:
            return score
    # two texts without a common word at any place differ by n, the most there is
    return n if most < wanted else wanted + 1


def sketch(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, tie (a hash of the text), digest of the words, their number, and the sketch values."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            digests, sizes, values = [], [], []
            for value in batch.column("text"):
                words = words_of(value.as_py())
                digests.append(hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                sizes.append(len(words))
                values.append(all_sketches(hashes(words, known)) if words else np.zeros(0, np.uint64))
            offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
            flat = np.concatenate([*values, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("tie"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["id", "tie", "digest", "n_words", "sketch"],
            )

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    return rows.mapInArrow(of, "id long, tie long, digest binary, n_words long, sketch array<long>")


def verify(pairs: DataFrame, words: DataFrame, held: int, stages: Stages, similarity: float = SIMILARITY) -> DataFrame:
    """Of ``pairs`` (a, b) those whose words align; ``words`` has id, the words' hashes and their number, ``held`` bytes in all."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = (np.frombuffer(v.as_py(), np.uint64).tolist() for v in (x, y))
                longer = max(len(a), len(b))
                most = int((1 - similarity) * longer + 1e-9)
                # a word that the other text lacks costs an edit
                lacking = max((Counter(a) - Counter(b)).total(), (Counter(b) - Counter(a)).total())
                keep.append(lacking <= most and banded_distance(a, b, most) <= most)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = words.select(F.col("id").alias("a"), F.col("words").alias("left"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("right"))
    # texts whose lengths alone differ by more are not brought together
    size_a, size_b = (words.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    close = F.expr(near_sizes("n_a", "n_b", similarity))
    pairs = pairs.join(size_a, "a").join(size_b, "b").where(close).select("a", "b", (F.col("n_a") * 8).alias("size"))
    return in_slices(pairs, held, lambda some: some.join(left, "a").join(right, "b").mapInArrow(align, "a long, b long"), stages)


def near_sizes(a: str, b: str, similarity: float) -> str:
    return f"least({a}, {b}) >= {similarity}D * greatest({a}, {b}) - 1e-6D"


def word_hashes(docs: DataFrame, doc_id: str, text: str, places: DataFrame) -> DataFrame:
    """node and hashed words of the rows that ``places`` (id, tie, node) names."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            hashed = pa.array([hashes(words_of(v.as_py()), known).tobytes() for v in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), hashed], ["id", "words"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    return rows.join(places, ["id", "tie"]).select("node", "text").mapInArrow(of, "id long, words binary").dropDuplicates(["id"])


def further_values(ids: DataFrame, words: DataFrame) -> DataFrame:
    """id, values (``bag_minima``), size (words) of ``ids`` (id); ``words`` has id, the words' hashes and their number. A text without words is not among them."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            minima = [bag_minima(np.frombuffer(v.as_py(), np.uint64)).view(np.int64) for v in batch.column("words")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(minima, pa.list_(pa.int64())), batch.column("n")], ["id", "values", "size"])

    return words.join(ids, "id", "left_semi").where("n > 0").select("id", "words", "n").mapInArrow(of, "id long, values array<long>, size double")


def marks(ids: DataFrame, words: DataFrame) -> DataFrame:
    """id, size (words) and marks (``bag_marks``) of ``ids`` (id); ``words`` has id, the words' hashes and their number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [bag_marks(np.frombuffer(v.as_py(), np.uint64)).tobytes() for v in batch.column("words")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(bits, pa.binary())], ["id", "size", "marks"])

    return words.join(ids, "id", "left_semi").select("id", "words", "n").mapInArrow(of, "id long, size double, marks binary")


def near_classes(docs: DataFrame, doc_id: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """id, tie (xxhash64 of the text), n_words and class of every id and text of ``docs``; a class is a number without meaning."""
    stages = Stages(docs.sparkSession)
    first = F.min(F.struct("digest", "n_words", "sketch")).alias("own")
    sketched = stages.write("sketches", sketch(docs, doc_id, text).groupBy("id", "tie").agg(first).select("id", "tie", "own.*", F.xxhash64("own.digest").alias("node")))
    # equal texts are one node, found at its smallest place
    copies = stages.write("copies", sketched.groupBy("node").agg(F.min(F.struct("id", "tie")).alias("at"), F.max("sketch").alias("sketch")))
    members = []
    for at in range(0, sum(SKETCHES.values()), AT_ONCE):
        some = copies.select(F.col("node").alias("id"), F.posexplode(F.slice("sketch", at + 1, AT_ONCE)).alias("place", "value"))
        members.append(some.select(F.xxhash64(F.col("place") + at, "value").alias("key"), "id"))
    candidates = candidate_pairs(members, stages)
    pairs = candidates.pairs
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    places = copies.join(wanted, "node").select("at.id", "at.tie", "node")
    words = stages.write("words", word_hashes(docs, doc_id, text, places).withColumn("n", F.octet_length("words") / 8))
    stages.release()
    held = int(words.agg(F.sum(F.octet_length("words"))).first()[0] or 0)
    near = near_sizes("size_a", "size_b", similarity)

    def judge(some: DataFrame) -> DataFrame:
        return verify(some, words, held, stages, similarity)

    def every(members: DataFrame, classes: DataFrame) -> DataFrame:
        return in_blocks(members, classes, judge, stages, lambda ids: marks(ids, words), partial(most_marks, similarity))

    linked = classes_of(candidates, judge, stages, lambda ids: further_values(ids, words), near, every)
    classes = linked.select(F.col("id").alias("node"), "class")
    stages.drop("words", "pairs")
    stages.release()
    return sketched.join(classes, "node", "left").select("id", "tie", "n_words", F.coalesce("class", "node").alias("class"))


def near_duplicates(docs: DataFrame, doc_id: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the class's smallest id) and n_words of every id of ``docs``, for each of its texts."""
    classes = Stages(docs.sparkSession).write("classes", near_classes(docs, doc_id, text, similarity))
    smallest = classes.groupBy("class").agg(F.min("id").alias("class_id"))
    return classes.join(smallest, "class").select(F.col("id").alias("doc_id"), "class_id", "n_words")


@query("op4_order_minhash")
def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), "doc_id", "text")
