"""Operators that SQL cannot express, held against plain loops over all rows or pairs."""

import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints, line_dedup, mixing, order_minhash

WORDS = "amber birch cedar delta ember fjord grove haven inlet juniper kelp lagoon meadow north opal pine quartz river stone tide".split()


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return [rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er", "ly"]) for _ in range(n)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def groups(items, alike):
    """Connected groups over all pairs."""
    of = list(range(len(items)))
    for i in range(len(items)):
        for j in range(i):
            if of[i] != of[j] and alike(items[i], items[j]):
                of = [of[j] if x == of[i] else x for x in of]
    out = defaultdict(list)
    for i, g in enumerate(of):
        out[g].append(i)
    return list(out.values())


def test_mix_of_every_source(spark):
    rng = random.Random(2)
    sizes = {"b": 40, "B": 4000, "é": 300, "a": 9000, None: 700, "": 20}
    rows, doc = [], 0
    for source, size in sizes.items():
        left = size
        while left:
            words = min(left, rng.randint(0, 15))
            rows.append((doc, source, words, "x"))
            doc, left = doc + 1, left - words
    rows += [(doc, "a", 0, "x"), (doc, "a", 0, "x")]
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_sources = {}, set(order)
    while open_sources:
        level = (1.5 * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if level * weight[s] > 2 * sizes[s]]
        target |= {s: 2 * sizes[s] for s in full} if full else {s: level * weight[s] for s in open_sources}
        open_sources -= set(target)
    frame = spark.createDataFrame(rows, "doc_id long, source string, words long, target string")
    got = mixing.mix(frame, "doc_id", "source", F.col("words")).collect()
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(r[:3] for r in rows)
    assert all(abs(taken[s] - target[s]) <= 15 for s in sizes)


def xx(*values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_fingerprint(text):
    words = [xx(w) for w in re.findall(r"\S{1,32}", text, re.ASCII)]
    inner = [xx(a, b) for a, b in zip(words, words[1:])]  # noqa: B905
    found = [xx(inner[i], inner[i + 2], inner[i + 3]) for i in range(len(words) - 4) if min(inner[i : i + 4]) in (inner[i], inner[i + 3])]
    return list(dict.fromkeys(x & 0x7FFFFFFF for x in found or map(xx, words)))


def brute_likeness(a, b):
    either = set(a) | set(b)
    return len(set(a) & set(b)) / len(either) if either else 1.0


def test_every_column_of_the_fingerprints(spark, tmp_path):
    texts = [(9, " ".join(prose(1, 60))), (2, None), (3, "é " * 9 + "x" * 100), (5, "one two"), (7, ""), (8, "\n".join(prose(2, 400))), (1, " ".join(prose(1, 59)))]
    spark.createDataFrame([(i, t, 1.0) for i, t in texts], "doc_id long, text string, near_next double").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in fingerprints.op6_fingerprints(spark, str(tmp_path)).collect()}
    ordered = sorted((i, t or "") for i, t in texts)
    for k, (doc, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, following = map(brute_fingerprint, (text, edited, after))
        row = got[doc]
        assert row["fingerprint"] == "".join(f"{x:08X}" for x in own) and row["edited_fingerprint"] == "".join(f"{x:08X}" for x in changed)
        assert (row["near_edited"], row["near_next"]) == pytest.approx((brute_likeness(own, changed), brute_likeness(own, following)))
    assert fingerprints.with_next(spark.createDataFrame([], "doc_id long, text string, tie long, anchors array<int>"), 3).count() == 0


def test_near_classes_against_all_pairs(spark):
    rng = random.Random(6)
    texts = []
    for base in range(12):
        words = prose(100 + base, rng.choice([25, 60, 150]))
        texts.append(words)
        for _ in range(rng.randrange(5)):
            changed = list(words)
            for at in rng.sample(range(len(words)), max(1, len(words) // 25)):
                changed[at] = "changed"
            texts.append(changed)
    texts += [prose(100, 10), prose(100, 10), [], ["x"], ["x"]]
    rows = [(3 * i, " ".join(t), "c") for i, t in enumerate(texts)]
    rows += [(rows[4][0], rows[4][1], "c"), (1000, None, "c"), (None, rows[0][1], "c")]
    got = defaultdict(set)
    frame = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    for r in order_minhash.near_duplicates(frame, "doc_id", "text").collect():
        got[r["class_id"]].add(r["doc_id"])
    items = [(i, t.split() if t else []) for i, t, _ in rows if i is not None]
    expected = groups(items, lambda a, b: distance(a[1], b[1]) <= 0.2 * max(len(a[1]), len(b[1])) + 1e-9)
    expected = {min(items[i][0] for i in g): {items[i][0] for i in g} for g in expected}
    assert got == expected


def test_lines_against_all_pairs(spark):
    """Every line taken out has an earlier one in its group over all pairs, equal lines are never kept twice."""
    rng = random.Random(7)
    lines = [" ".join(prose(300 + i, rng.randint(4, 30))) for i in range(25)]
    near = []
    for line in lines:
        at = rng.randrange(len(line))
        near.append(line[:at] + "z" + line[at + 1 :])
    every = [*lines, *near, *lines[:10], *[x.upper() + " !" for x in lines[:5]], "...", "..."]
    rng.shuffle(every)
    docs = [(i, "\n".join(every[4 * i : 4 * i + 4]), 0) for i in range(-(-len(every) // 4))]
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, n_lines int"), "doc_id", "text").collect()}
    plain = [re.sub(r"[^a-z]+", " ", x.lower()).strip() for x in every]
    first = {}
    for g in groups(plain, lambda a, b: bool(a and b) and distance(a, b) <= 0.2 * max(len(a), len(b))):
        for i in g:
            first[i] = min(g)
    seen, removed = set(), 0
    for doc, text, _ in docs:
        kept = Counter(got[doc])
        for n, line in enumerate(text.split("\n")):
            i = 4 * doc + n
            if kept[line]:
                kept[line] -= 1
                assert not plain[i] or plain[i] not in seen, line
            else:
                removed += 1
                assert plain[i] and first[i] < i, line
            seen.add(plain[i])
        assert not sum(kept.values()) or kept == Counter({"": 1})
    # the 15 repeated lines for certain, and most of the 25 with a letter changed
    assert 15 + 12 <= removed <= 15 + 25


def test_pipeline_from_documents_to_pieces(spark, tmp_path):
    import corpus_pipeline

    tongues = {"en": "the and with from", "xx": "zuk lor pimu wax"}
    rows = []
    for i in range(40):
        lang = ("en", "xx")[i % 2]
        rng = random.Random(i)
        text = " ".join(rng.choice(prose(i, 30) + tongues[lang].split() * 8) + ("" if lang == "en" else "uz") for _ in range(90))
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    rows.append((50, rows[6][1] + " extra", "en", "s1", len(rows[6][1]) + 6))
    rows.append((51, rows[8][1], "en", None, len(rows[8][1])))
    rows += [(60, "12345 !!", None, "s0", 8), (61, None, None, None, None), (62, "", "en", "s2", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    known = corpus_pipeline.identify_language(spark, docs, str(tmp_path))
    assert known.columns == docs.columns and {r["doc_id"] for r in known.collect()} == {r[0] for r in rows} - {60, 61, 62}
    lines = {r["doc_id"]: r for r in corpus_pipeline.dedup_lines(spark, known, "").collect()}
    # copies of a whole line leave nothing, so their documents go; the others keep their text
    assert set(lines) == set(range(40)) and all(lines[i]["text"] == rows[i][1] and lines[i]["n_chars"] == rows[i][4] for i in lines)
    near = corpus_pipeline.dedup_documents(spark, known, "").collect()
    assert {r["doc_id"] for r in near} == set(range(40)) and len(near) == 40
    mixed = Counter(r["doc_id"] for r in corpus_pipeline.mix_sources(spark, spark.createDataFrame(near, schema), "").collect())
    assert set(mixed.values()) <= {1, 2} and sum(mixed.values()) > 40
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} <= set(range(40)) and all(0 < p["length"] <= 2048 for p in pieces)
    held = defaultdict(int)
    for p in pieces:
        held[p["sequence_id"]] += p["length"]
    assert max(held.values()) <= 2048 and len(held) <= -(-sum(held.values()) // 2048) + 1

    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES[3:]:
        assert stage(spark, empty, "").count() == 0

def test_near_classes_of_texts_that_share_a_passage(spark):
    rng = random.Random(16)
    passage = prose(1, 60)
    texts = []
    for base in range(60):
        own = [f"{w}{base}" for w in prose(200 + base, rng.randint(40, 70))]
        texts.append(own[:20] + passage + own[20:])
        if base % 6 == 0:  # at the lower end of what is a near copy
            changed = list(texts[-1])
            for at in rng.sample(range(len(changed)), len(changed) // 6):
                changed[at] = f"changed{base}"
            texts.append(changed)
    expected = groups(texts, lambda a, b: distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = defaultdict(list)
    for r in order_minhash.near_duplicates(frame, "doc_id", "text").collect():
        got[r["class_id"]].append(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(expected)
