"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent n-grams (one to three letters, word
boundaries included), most frequent first. A document belongs to the language
whose profile is closest by out-of-place distance: the sum, over the document's
own profile, of how far each n-gram is from its place in the language's profile;
an n-gram the language does not have counts as a full profile length.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as
is everything when nothing could be learned. Rows with null text or language teach
nothing. Ties between n-grams go to the smaller n-gram, between languages to the
smaller name. Repeated rows are judged alike, one output row per input row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import query
from tallyhouse.llm.common import Stages, documents

UNDETERMINED = "und"
PROFILE_LENGTH = 400
#: Learning reads about so many documents of each language, chosen by a hash of their id.
TRAIN_DOCUMENTS_PER_LANGUAGE = 5_000
MAX_LANGUAGES = 1_000
CHUNK_CHARS = 1_000_000
_EDGE = 1  # stands for the edge of a word; 0 for "no letter here" in shorter n-grams
_BITS = 21  # a code point


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index, n-gram (three code points in one integer) and count, by document and n-gram."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    points = np.frombuffer("\x01".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(letters[points], points, _EDGE)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    starts = np.concatenate(([0], ends[:-1]))
    # one edge between words; a document starts with an edge of its own
    points = np.insert(points, starts, _EDGE)
    doc = np.insert(doc, starts, np.arange(len(texts)))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != _EDGE) | (points[:-1] != _EDGE) | (doc[1:] != doc[:-1])
    points, doc = points[keep], doc[keep]

    alphabet, symbol = np.unique(points, return_inverse=True)
    size = len(alphabet) + 1
    symbol = symbol.astype(np.int64) + 1
    is_letter = points != _EDGE
    base = doc.astype(np.int64) * size**3
    pair = doc[1:] == doc[:-1]
    triple = pair[1:] & pair[:-1] & is_letter[1:-1]
    codes = np.concatenate((
        (base + symbol)[is_letter],
        (base[1:] + symbol[:-1] * size + symbol[1:])[pair],
        (base[2:] + (symbol[:-2] * size + symbol[1:-1]) * size + symbol[2:])[triple],
    ))
    codes.sort()
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    count = np.diff(first, append=len(codes))
    codes = codes[first]
    of, code = np.divmod(codes, size**3)
    spelled = np.concatenate(([0], alphabet.astype(np.int64)))
    a, rest = np.divmod(code, size**2)
    b, c = np.divmod(rest, size)
    return of, (spelled[a] << 2 * _BITS) | (spelled[b] << _BITS) | spelled[c], count


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """Texts of a batch in runs of about CHUNK_CHARS, with the row each run starts at."""
    start, held, chars = 0, [], 0
    for i, text in enumerate(batch.column(column).to_pylist()):
        held.append(text or "")
        chars += len(held[-1])
        if chars >= CHUNK_CHARS:
            yield start, held
            start, held, chars = i + 1, [], 0
    if held:
        yield start, held


def learn(docs: DataFrame, text: str, lang: str, key: Column, profile_length: int = PROFILE_LENGTH) -> dict[str, np.ndarray]:
    """Profile of every language: its most frequent n-grams in order.

    ``key`` decides which documents are read where a language has more than
    TRAIN_DOCUMENTS_PER_LANGUAGE; the choice is the same in every run.
    """
    spark = docs.sparkSession
    usable = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy(lang).count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; raise MAX_LANGUAGES if that is meant")
    if not sizes:
        return {}
    place = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    chosen = F.lit(False)
    for name, n in sizes.items():
        bound = int(1_000_000 * min(1.0, TRAIN_DOCUMENTS_PER_LANGUAGE / n))
        chosen = chosen | ((F.col(lang) == name) & (place < bound))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for start, texts in chunks(batch, "text"):
                of, gram, n = ngrams(texts, letters)
                names = langs[start + of] if len(of) else np.array([], object)
                for name in sorted(set(names)):
                    mine = names == name
                    unique, inverse = np.unique(gram[mine], return_inverse=True)
                    total = np.bincount(inverse, n[mine]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(unique), pa.string()), pa.array(unique), pa.array(total)], ["lang", "gram", "n"])

    stages = Stages(spark)
    rows = usable.where(chosen).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = stages.write(
        "ngrams",
        rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")),
    )
    profiles = {}
    for name in sorted(sizes):
        top = counted.where(F.col("lang") == name).orderBy(F.desc("n"), "gram").limit(profile_length).collect()
        if top:
            profiles[name] = np.array([r["gram"] for r in top], np.int64)
    stages.drop("ngrams")
    return profiles


def distances(texts: list[str], letters: np.ndarray, grams: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of every text to every language, and the size of each text's own profile.

    ``grams`` are the sorted n-grams of all profiles; ``places`` has a row for each, plus a
    last one for unknown n-grams, and a column for each language.
    """
    of, gram, n = ngrams(texts, letters)
    order = np.argsort((of << 32) - n, kind="stable")
    of, gram = of[order], gram[order]
    sizes = np.bincount(of, minlength=len(texts))
    rank = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = rank < length
    of, gram, rank = of[kept], gram[kept], rank[kept]
    at = np.searchsorted(grams, gram)
    at[at == len(grams)] = 0
    place = places[np.where(grams[at] == gram, at, len(grams))]
    off = np.where(place < length, np.abs(place - rank[:, None]), length)
    total = np.zeros((len(texts), places.shape[1]))
    for k in range(places.shape[1]):
        total[:, k] = np.bincount(of, off[:, k], minlength=len(texts))
    return total, np.minimum(sizes, length)


def identify(docs: DataFrame, text: str, profiles: dict[str, np.ndarray], profile_length: int = PROFILE_LENGTH) -> DataFrame:
    """``docs`` with lang_pred and score: 1 minus the distance as a share of the largest possible.

    Columns of ``docs`` named lang_pred or score are replaced.
    """
    names = sorted(profiles)
    grams = np.unique(np.concatenate([*profiles.values(), np.zeros(1, np.int64)]))
    places = np.full((len(grams) + 1, len(names)), profile_length)
    for k, name in enumerate(names):
        places[np.searchsorted(grams, profiles[name]), k] = np.arange(len(profiles[name]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            langs, scores = [], []
            for _, texts in chunks(batch, text):
                if not names:
                    langs += [UNDETERMINED] * len(texts)
                    scores.append(np.zeros(len(texts)))
                    continue
                total, size = distances(texts, letters, grams, places, profile_length)
                best = total.argmin(axis=1)
                langs += [names[b] if s else UNDETERMINED for b, s in zip(best, size, strict=True)]
                share = total[np.arange(len(texts)), best] / np.maximum(size * profile_length, 1)
                scores.append(np.where(size > 0, 1 - share, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))],
                [*kept, "lang_pred", "score"],
            )

    rows = docs.drop("lang_pred", "score")
    kept = rows.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(predict, f"{fields}, lang_pred string, score double")


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    profiles = learn(docs.where(~held_out), "text", "lang", F.col("doc_id"))
    judged = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), "text", profiles)
    return judged.drop("text")
