"""Documents scored by masked pseudo-likelihood under a small bidirectional network.

Every token is predicted from the words on both sides of it, itself masked; the sum of
the log-probabilities is the document's score. Words belong to classes: the most
frequent ones have a class each, the other words of the vocabulary and the words
outside it share classes by their ending. The network (one embedding for each side, a
tanh layer, a softmax) gives the class from the classes left and right; within a class
a vocabulary word has its share of the corpus, and a word outside it the share of one
of the class's word types.

Spark counts every word and every (left, right, middle) class triple of all documents.
That table has CLASSES ** 3 cells at most, whatever the corpus, and it is all that
full-batch training needs, so numpy trains on the whole corpus at a fixed cost. Scoring
looks the network's output up by context.

Defined results: a null text or one without words has no tokens, log_prob 0, and null
mean_log_prob and perplexity. Repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents

VOCABULARY = 8_192
OWN_CLASS = 31
KNOWN_ENDINGS = 16
RARE_ENDINGS = 16
EDGE = OWN_CLASS + KNOWN_ENDINGS + RARE_ENDINGS
CLASSES = EDGE + 1
EMBEDDING, HIDDEN, STEPS, RATE = 16, 32, 300, 0.03
#: Entries a task holds before it passes its counts on.
HELD_WORDS = 400_000


def ending(word: str) -> int:
    return zlib.crc32(word[-2:].encode("utf-8", "surrogatepass"))


def rare_class(word: str) -> int:
    return OWN_CLASS + KNOWN_ENDINGS + ending(word) % RARE_ENDINGS


class Tokens(dict):
    """Word -> (vocabulary place or, for others, VOCABULARY + class); remembers a bounded number of others."""

    def __init__(self, vocabulary: list[str]) -> None:
        super().__init__({w: i for i, w in enumerate(vocabulary)})
        self.fixed = len(self)

    def __missing__(self, word: str) -> int:
        place = VOCABULARY + rare_class(word)
        if len(self) < self.fixed + HELD_WORDS:
            self[word] = place
        return place

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def class_table(vocabulary: list[str]) -> np.ndarray:
    """Class of every place a token can have."""
    table = np.arange(VOCABULARY + CLASSES) - VOCABULARY
    for i, word in enumerate(vocabulary):
        table[i] = i if i < OWN_CLASS else OWN_CLASS + ending(word) % KNOWN_ENDINGS
    return table


def contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.concatenate(([EDGE], classes[:-1]))
    right = np.concatenate((classes[1:], [EDGE]))
    return left, right


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """word, n over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for value in batch.column("text"):
                held.update((value.as_py() or "").split())
                if len(held) > HELD_WORDS:
                    yield table(held)
                    held = Counter()
        yield table(held)

    def table(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def count_triples(docs: DataFrame, text: str, vocabulary: list[str]) -> DataFrame:
    """cell, n: how often each (left, right, middle) triple of classes occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, table = Tokens(vocabulary), class_table(vocabulary)
        seen = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            cells = []
            for value in batch.column("text"):
                middle = table[tokens.of(value.as_py())]
                if len(middle):
                    left, right = contexts(middle)
                    cells.append((left * CLASSES + right) * CLASSES + middle)
            if cells:
                seen += np.bincount(np.concatenate(cells), minlength=CLASSES**3)
        cell = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(seen[cell])], ["cell", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def train(counts: np.ndarray) -> np.ndarray:
    """Log-probability of the middle class for every (left, right); ``counts`` has the same three axes."""
    rng = np.random.default_rng(0)
    weights = {
        "left": rng.normal(0, 0.3, (CLASSES, EMBEDDING)),
        "right": rng.normal(0, 0.3, (CLASSES, EMBEDDING)),
        "hidden": rng.normal(0, 0.3, (2 * EMBEDDING, HIDDEN)),
        "shift": np.zeros(HIDDEN),
        "out": rng.normal(0, 0.1, (HIDDEN, CLASSES)),
        "base": np.log((counts.sum(axis=(0, 1)) + 1) / (counts.sum() + CLASSES)),
    }
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    target = counts.reshape(-1, CLASSES) / max(1.0, counts.sum())
    mass = target.sum(axis=1, keepdims=True)
    left, right = np.divmod(np.arange(CLASSES**2), CLASSES)

    def forward() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        given = np.concatenate((weights["left"][left], weights["right"][right]), axis=1)
        hidden = np.tanh(given @ weights["hidden"] + weights["shift"])
        return given, hidden, log_softmax(hidden @ weights["out"] + weights["base"])

    for step in range(1, STEPS + 1):
        given, hidden, logs = forward()
        off = np.exp(logs) * mass - target
        back = (off @ weights["out"].T) * (1 - hidden**2)
        to_given = (back @ weights["hidden"].T).reshape(CLASSES, CLASSES, 2 * EMBEDDING)
        slope = {
            "left": to_given[:, :, :EMBEDDING].sum(axis=1),
            "right": to_given[:, :, EMBEDDING:].sum(axis=0),
            "hidden": given.T @ back,
            "shift": back.sum(axis=0),
            "out": hidden.T @ off,
            "base": off.sum(axis=0),
        }
        for k, g in slope.items():  # Adam
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return forward()[2].reshape(CLASSES, CLASSES, CLASSES)


def fit(docs: DataFrame, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Vocabulary, log-probability of each token place within its class, and the network's output table."""
    stages = Stages(docs.sparkSession)
    words = stages.write("words", count_words(docs, text))
    top = words.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    vocabulary = [r["word"] for r in top]
    rare = F.pmod(F.crc32(F.substring("word", -2, 2).cast("binary")), F.lit(RARE_ENDINGS))
    last = F.lit(top[-1]["n"] if top else 0)
    outside = words.where((F.col("n") < last) | ((F.col("n") == last) & (F.col("word") > F.lit(vocabulary[-1] if top else ""))))
    types = {OWN_CLASS + KNOWN_ENDINGS + r["c"]: r["types"] for r in outside.groupBy(rare.alias("c")).agg(F.count("*").alias("types")).collect()}
    table = class_table(vocabulary)
    totals = np.zeros(CLASSES)
    known = np.array([r["n"] for r in top], float)
    np.add.at(totals, table[: len(known)], known)
    within = np.zeros(VOCABULARY + CLASSES)
    within[: len(known)] = np.log(known / totals[table[: len(known)]]) if len(known) else []
    for c, n in types.items():
        within[VOCABULARY + c] = -np.log(n)
    counts = np.zeros(CLASSES**3)
    for r in count_triples(docs, text, vocabulary).collect():  # CLASSES ** 3 rows at most
        counts[r["cell"]] = r["n"]
    stages.drop("words")
    return vocabulary, within, train(counts.reshape(CLASSES, CLASSES, CLASSES))


def score(docs: DataFrame, doc_id: str, text: str, vocabulary: list[str], within: np.ndarray, logs: np.ndarray) -> DataFrame:
    """doc_id, n_tokens, log_prob, mean_log_prob and perplexity of every row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, table = Tokens(vocabulary), class_table(vocabulary)
        for batch in batches:
            sizes, sums = [], []
            for value in batch.column("text"):
                place = tokens.of(value.as_py())
                middle = table[place]
                sizes.append(len(place))
                sums.append(float((logs[(*contexts(middle), middle)] + within[place]).sum()) if len(place) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc_id", "n_tokens", "log_prob"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(judge, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, log_prob double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.withColumn("mean_log_prob", mean).withColumn("perplexity", F.exp(-F.col("mean_log_prob")))


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, "doc_id", "text", *fit(docs, "text"))
