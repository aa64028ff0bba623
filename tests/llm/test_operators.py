"""The training-data operators on awkward rows, and against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import (
    fingerprints,
    language_id,
    line_dedup,
    linking,
    lm_scoring,
    mixing,
    order_minhash,
    packing,
    substring_dedup,
    topk_search,
    url_filter,
)
from tallyhouse.llm.common import Stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id_ string, class string, score double"
WORDS = "amber birch cedar delta ember fjord grove haven inlet juniper kelp lagoon meadow north opal".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 120)
    near = base.split()
    near[40] = "changed"
    out = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, " ".join(near), "en", None),
        (4, prose(2, 90) + "\n" + prose(3, 12), "en", "b"),
        (5, prose(4, 80) + "\n" + prose(3, 12), "en", "b"),
        (6, None, None, None),
        (7, "", "en", ""),
        (8, "!!! ???", None, "c"),
        (9, "x" * 5000, "en", "a"),
        (10, prose(5, 4000), "en", "a"),
        (12, prose(6, 60), "en", "c"),
        (12, prose(6, 60), "en", "c"),
        (None, prose(7, 60), "en", "c"),
    ]
    return [(i, t, lang, s, len(t or ""), "x", "y", 0.5) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    assert language_id.identify(empty, "text", language_id.learn(empty, "text", "lang", F.col("doc_id"))).count() == 0
    assert line_dedup.dedup_lines(empty, "doc_id", "text").count() == 0
    assert mixing.mix(empty, "doc_id", "source", mixing.word_count(F.col("text"))).count() == 0
    assert packing.pack(empty, "doc_id", "text").count() == 0
    assert order_minhash.near_duplicates(empty, "doc_id", "text").count() == 0
    assert substring_dedup.dedup_substrings(empty, "doc_id", "text").count() == 0
    assert lm_scoring.score(empty, "doc_id", "text", *lm_scoring.fit(empty, "text")).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0).count() == 0


def test_language_of_awkward_rows(spark, docs):
    german = spark.createDataFrame([(100 + i, "über straße größe müssen fünf zwölf " * 5, "de") for i in range(3)], "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").union(german)
    profiles = language_id.learn(both, "text", "lang", F.col("doc_id"))
    judged = language_id.identify(docs, "text", profiles)
    assert judged.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    got = {r["doc_id"]: r for r in judged.collect()}
    assert got[1]["lang_pred"] == got[4]["lang_pred"] == "en"
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (6, 7, 8)] == [("und", 0.0)] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_held_out(spark):
    from tallyhouse.llm.common import documents

    judged = language_id.op9_language_id(spark, "/root/testdata/sf0.001").where("held_out")
    right = judged.join(documents(spark, "/root/testdata/sf0.001"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


def test_lines_keep_first_occurrence(docs, rows):
    got = defaultdict(list)
    for r in line_dedup.dedup_lines(docs, "doc_id", "text").collect():
        got[r["doc_id"]].append(r)
    assert got[1][0]["text"] == rows[0][1]
    assert got[2][0]["text"] == "" and got[2][0]["n_removed"] == 1
    assert got[3][0]["n_removed"] == 1  # one word of 120 differs
    assert got[5][0]["text"] == prose(4, 80)
    assert got[6][0]["text"] is None and got[7][0]["text"] == "" and got[8][0]["text"] == "!!! ???"
    assert [r["text"] for r in got[12]] == [prose(6, 60)] * 2
    assert got[None][0]["text"] == prose(7, 60)
    assert got[1][0]["class"] == "y"


def test_lines_of_a_text_are_normalised_alike(spark):
    rng = random.Random(8)
    signs = "ab1 \t\r\n\n ,.;-_~ \u00a0\u00bf\u2003\u3002\u00c9\u03a3\u03c3"
    texts = ["", "\n", " ", "  a  b ", "a ,b", "a, b\n", *("".join(rng.choice(signs) for _ in range(40)) for _ in range(300))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    whole = F.transform(line_dedup.normalised_lines(F.col("text")), lambda x: F.trim(x))
    single = F.transform(F.split("text", "\n"), line_dedup.normalised)
    assert [r for r in frame.select("text", whole.alias("a"), single.alias("b")).collect() if r["a"] != r["b"]] == []


def test_simhash_is_the_weighted_majority(spark):
    line = spark.createDataFrame([(7, w) for w in prose(9, 30).split()], "line long, word string")
    votes = np.zeros(64)
    for h, n in line.select(F.xxhash64("word"), F.length("word")).collect():
        votes += min(n, 16) ** 2 * (((np.uint64(h % 2**64) >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(float) * 2 - 1)
    expected = sum(1 << int(i) for i in np.flatnonzero(votes > 0))
    assert line_dedup.simhash(line).first()["simhash"] % 2**64 == expected


def test_mix_hits_targets(spark):
    rng = random.Random(3)
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", rng.randint(0, 60)) for i in range(3000)]
    frame = spark.createDataFrame([*rows, (3001, None, 50), (3002, "s1", 0)], "doc_id long, source string, words long")
    got = mixing.mix(frame, "doc_id", "source", F.col("words")).collect()
    assert len(got) == 3002 and all(0 <= r["copies"] <= 2 for r in got)
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 30.001 and target[s] <= 2 * size[s] for s in target)
    again = mixing.mix(frame.repartition(5), "doc_id", "source", F.col("words")).collect()
    assert Counter(got) == Counter(again)


def test_packing_round_trip(docs, rows):
    pieces = packing.pack(docs, "doc_id", "text").collect()
    encoder = packing.Encoder()
    whole = Counter()
    by_doc = defaultdict(list)
    for p in pieces:
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and p["length"] == len(p["ids"]) <= 2048
        by_doc[p["doc_id"]].append(p)
    for doc, text in {r[0]: r[1] for r in rows}.items():
        own = sorted(by_doc[doc], key=lambda p: p["piece"])
        if doc != 12:
            assert sum((list(p["ids"]) for p in own), []) == encoder.file.encode(text or "", add_special_tokens=False).ids + [0]
            assert all(p["length"] == 2048 for p in own[1:])
    places = defaultdict(list)
    for p in pieces:
        places[p["sequence_id"]].append((p["offset"], p["length"]))
        whole["tokens"] += p["length"]
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= -(-whole["tokens"] // 2048) + 1


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 6 + 3 and leaves 1; the 3 makes room for 2 + 2
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == ({6: 1, 2: 2}, 1)


def test_classes_and_alignment(docs):
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs, "doc_id", "text").collect()}
    assert got[1] == got[2] == got[3] == 1
    assert got[4] == 4 and got[5] == 5 and got[6] == got[7] == 6 and got[12] == 12 and None not in got
    rng = random.Random(0)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        most = rng.randrange(8)
        assert order_minhash.banded_distance(a, b, most) == min(row[-1], most + 1)


def test_top_k_awkward_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-2, 2)) / 4 for _ in range(6)]) for i in range(700)]
    rows += [(1000, None), (1100, [1.0, None]), (1200, [float("nan")]), (1300, [float("inf"), 1.0]), (1400, [1.0]), (None, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in topk_search.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 100 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    points = {i: np.pad(np.floor(1024 * np.array(v)), (0, 6 - len(v))) for i, v in rows if i is not None and (i < 1000 or i == 1400)}
    assert set(got) == {i for i in points if i % 100 == 0}
    for q, found in got.items():
        best = sorted((-int(points[q] @ v), i) for i, v in points.items() if i != q)[:10]
        assert sorted(found) == [(n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_fingerprints(docs):
    frame = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = {r["doc_id"]: r["f"] for r in frame.select("doc_id", fingerprints.fingerprint(F.col("text")).alias("f")).collect()}
    assert got[1] == got[2] and got[6] == got[7] == [] and len(got[9]) == len(set(got[9]))
    shared = len(set(got[1]) & set(got[3])) / len(set(got[1]) | set(got[3]))
    assert 0.8 < shared < 1


def test_closed_syncmers_against_brute_force(spark):
    text = prose(11, 60)
    words = [r[0] for r in spark.createDataFrame([(w,) for w in text.split()], "w string").select(F.xxhash64("w")).collect()]
    pairs = spark.createDataFrame(list(zip(words, words[1:])), "a long, b long").select(F.xxhash64("a", "b")).collect()
    inner = [r[0] for r in pairs]
    chosen = [i for i in range(len(words) - 4) if min(inner[i : i + 4]) in (inner[i], inner[i + 3])]
    frame = spark.createDataFrame([(text,)], "text string")
    assert len(frame.select(fingerprints.fingerprint(F.col("text"))).first()[0]) == len(chosen)


def test_substrings_against_brute_force(docs, rows):
    got = defaultdict(list)
    for r in substring_dedup.dedup_substrings(docs, "doc_id", "text").collect():
        got[r["doc_id"]].append(r)
    seen: set[bytes] = set()
    for doc, text in sorted({(r[0], r[1] or "") for r in rows if r[0] is not None}):
        raw = text.encode()
        gone = bytearray(len(raw))
        strings = [raw[i : i + 50] for i in range(len(raw) - 49)]
        for i, s in enumerate(strings):
            if s in seen:
                gone[i : i + 50] = b"\1" * 50
        seen.update(strings)
        for r in got[doc]:
            assert bytes(r["kept"]) == bytes(x for x, g in zip(raw, gone) if not g) and r["n_removed"] == sum(gone)
    assert len(got[12]) == 2 and got[None][0]["n_removed"] == 0


def test_scores_against_a_loop(docs, rows):
    vocabulary, within, logs = lm_scoring.fit(docs, "text")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, "doc_id", "text", vocabulary, within, logs).collect()}
    place = {w: i for i, w in enumerate(vocabulary)}
    table = lm_scoring.class_table(vocabulary)
    assert np.exp(logs).sum(axis=-1) == pytest.approx(np.ones((lm_scoring.CLASSES,) * 2))
    words = rows[3][1].split()
    classes = [lm_scoring.EDGE, *(table[place[w]] for w in words), lm_scoring.EDGE]
    total = sum(logs[classes[i - 1], classes[i + 1], classes[i]] + within[place[w]] for i, w in enumerate(words, 1))
    assert got[4]["log_prob"] == pytest.approx(total) and got[4]["n_tokens"] == len(words)
    assert got[6]["n_tokens"] == 0 and got[6]["log_prob"] == 0 and got[6]["perplexity"] is None
    shuffled = got[10]["mean_log_prob"]
    assert shuffled < 0


def test_url_verdicts(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "http://example.net", None, "no scheme", "ftp://x.org/fr/", "http://a.net/b", "http://anet/", "http://a.net/b"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(7, urls[7], "y")], "page_id long, url string, key string")
    rules = spark.sql(f"SELECT * FROM {url_filter.RULES} AS r(host, path, verdict) UNION ALL SELECT null, '/', 'block'")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, "page_id", "url", rules).collect())
    expected = [
        (0, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (1, "example.net", "", None, "allow"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "x.org", "/fr/", "org/fr/", "allow"),
        (5, "a.net", "/b", "net/", "block"),
        (6, "anet", "/", None, "allow"),
        (7, "a.net", "/b", "net/", "block"),
        (7, "a.net", "/b", "net/", "block"),
    ]
    assert Counter(got) == Counter(expected)


def test_urls_of_any_length_and_no_rules(spark):
    deep = "a." * 100_000 + "example.net"
    urls = ["!://" + "x" * 1_000_000, f"http://{deep}/en/" + "p" * 1_000_000, f"http://{deep}/e", "http://net" + "/" * 500_000, "", "://", "http://b.org/fr"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.sql(f"SELECT * FROM {url_filter.RULES} AS r(host, path, verdict)")
    got = {r["page_id"]: (r["rule"], r["verdict"], len(r["host"]), len(r["path"])) for r in url_filter.judge(pages, "page_id", "url", rules).collect()}
    assert got == {
        0: (None, "allow", 1_000_000, 0),
        1: ("example.net/en/", "allow", len(deep), 1_000_004),
        2: ("net/", "block", len(deep), 2),
        3: ("net/", "block", 3, 500_000),
        4: (None, "allow", 0, 0),
        5: (None, "allow", 0, 0),
        6: (None, "allow", 5, 3),
    }
    assert {r["verdict"] for r in url_filter.judge(pages, "page_id", "url", rules.limit(0)).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), "page_id", "url", rules).count() == 0


def test_op6_digest_columns(spark, tmp_path):
    texts = [(1, "ab" * 30), (2, None), (4, prose(1, 40)), (9, "")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in fingerprints.op6_fingerprints(spark, str(tmp_path)).collect()}
    for k, (doc, text) in enumerate(texts):
        text, after = text or "", texts[(k + 1) % len(texts)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[doc]["n_chars"] == len(text)


def test_lines_with_a_typo_in_a_long_word(spark):
    lines = [f"{w}shire is seen from the {prose(20 + i, 30)}" for i, w in enumerate(WORDS)]
    texts = [*lines, *(x.replace("shire", "shirx") for x in lines)]
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text")
    assert got.agg(F.sum("n_removed")).first()[0] > 0.9 * len(lines)


def test_links_within_a_large_bucket(spark):
    alike = [{5, 6}, {11, 30, 47}, {60, 61, 62}, set(range(100, 400))]
    members = spark.range(500).select(F.lit(7).cast("long").alias("key"), "id")
    links = spark.createDataFrame([(a, b) for some in alike for a in some for b in some if a < b], "a long, b long")
    stages = Stages(spark)
    classes = linking.classes_of(linking.candidate_pairs([members], stages), lambda pairs: pairs.join(links, ["a", "b"]), stages)
    found = defaultdict(set)
    for r in classes.collect():
        found[r["class"]].add(r["id"])
    assert sorted(map(min, found.values())) == [5, 11, 60, 100] and all(some in alike for some in found.values())


def test_links_between_the_classes_of_two_leaders(spark, monkeypatch):
    """Every member is in the class of the smallest or of the largest id; one link joins them, and it has no leader."""
    monkeypatch.setattr(linking, "PART", 3)
    members = spark.range(12).select(F.lit(7).cast("long").alias("key"), "id")
    middle = members.orderBy(F.xxhash64("id")).first()["id"]
    x = next(i for i in (1, 2, 3) if i != middle)
    y = next(i for i in (8, 9, 10) if i != middle)
    links = spark.createDataFrame([*((0, i) for i in range(1, 6)), *((i, 11) for i in range(6, 11)), (x, y)], "a long, b long")
    stages = Stages(spark)
    classes = linking.classes_of(linking.candidate_pairs([members], stages), lambda pairs: pairs.join(links, ["a", "b"]), stages)
    assert {(r["id"], r["class"]) for r in classes.collect()} == {(i, 0) for i in range(12)}


def test_simhash_of_a_heavy_line(spark, monkeypatch):
    words = spark.range(9_000_000).select(F.lit(7).cast("long").alias("line"), F.lit("w" * 16).alias("word"))
    assert line_dedup.simhash(words).first()["simhash"] == words.select(F.xxhash64("word")).first()[0]
    # the same lines are removed when every line is taken for a long one
    docs = spark.createDataFrame([(i, prose(i % 9, 30) + (" end" if i > 9 else "")) for i in range(20)], "doc_id long, text string")
    light = line_dedup.dedup_lines(docs, "doc_id", "text").collect()
    monkeypatch.setattr(line_dedup, "SHORT", 1)
    assert Counter(line_dedup.dedup_lines(docs, "doc_id", "text").collect()) == Counter(light)


def test_scattered_edits_up_to_the_threshold(spark):
    rng = random.Random(12)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(200), 39):
            words[at] = f"v{rng.randrange(5000)}"
        rows.append((2 * i + 1, " ".join(words)))
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert all(got[2 * i] == 2 * i and got[2 * i + 1] in (2 * i, 2 * i + 1) for i in range(60))
    assert sum(got[2 * i + 1] == 2 * i for i in range(60)) >= 54


def test_substrings_of_a_hot_phrase_start(spark, monkeypatch):
    passage = prose(30, 40)
    texts = [(i, f"{prose(100 + i, 6)} {i} {passage} {i % 7} {prose(200 + i % 7, 8)}") for i in range(60)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    expected = Counter((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in substring_dedup.dedup_substrings(frame, "doc_id", "text").collect())
    most = []

    def judge(entries, judge=substring_dedup.answers):
        most.append(entries.groupBy("start").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0])
        return judge(entries)

    monkeypatch.setattr(substring_dedup, "HOT", 5, raising=False)
    monkeypatch.setattr(substring_dedup, "answers", judge)
    got = Counter((r["doc_id"], bytes(r["kept"]), r["n_spans"]) for r in substring_dedup.dedup_substrings(frame, "doc_id", "text").collect())
    assert got == expected and any(n_spans for _, _, n_spans in got)
    assert max(most) <= 5


def test_texts_that_share_an_id_stay_apart(spark):
    import corpus_pipeline

    one, other = prose(40, 80), prose(41, 80)
    rows = [(1, one, "b"), (1, one, "a"), (1, other, "a"), (2, one + " more", "a"), (3, other, "a"), (4, prose(42, 80), "a"), (None, one, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.dedup_documents(spark, docs, "").collect()
    assert Counter(map(tuple, got)) == Counter([(1, one, "a"), (1, other, "a"), rows[5], rows[6]])


def test_a_large_bucket_is_settled_by_further_keys(spark):
    """Every link is found, with far fewer pairs than the bucket has."""
    alike = [{5, 6}, {11, 30, 47}, {60, 61, 62}, set(range(100, 400))]
    members = spark.range(3000).select(F.lit(7).cast("long").alias("key"), "id")
    links = spark.createDataFrame([(a, b) for some in alike for a in some for b in some if a < b], "a long, b long")
    first = spark.createDataFrame([(i, min(some)) for some in alike for i in some], "id long, of long")
    tried = []

    def verify(pairs):
        tried.append(pairs.count())
        return pairs.join(links, ["a", "b"])

    def further(ids):
        # alike ids agree in some three of four values, two thirds being the least that alike texts have
        own = F.transform(F.sequence(F.lit(1), F.lit(linking.VALUES)), lambda i: F.when(F.xxhash64("id", i) % 8 == 0, F.xxhash64("id", i)).otherwise(F.xxhash64("of", i)))
        return ids.join(first, "id", "left").withColumn("of", F.coalesce("of", "id")).select("id", own.alias("values"))

    stages = Stages(spark)
    classes = linking.classes_of(linking.candidate_pairs([members], stages), verify, stages, further)
    found = defaultdict(set)
    for r in classes.collect():
        found[r["class"]].add(r["id"])
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, alike))
    assert sum(tried) < 20 * 3000
    places = linking.key_places()
    assert [{len(set(key)) for key in keys} for keys in places] == [{4}, {6}] and [len(keys) for keys in places] == [16, 40]


def test_only_starts_with_different_surroundings_are_judged_by_their_bytes(spark, monkeypatch):
    rng = random.Random(7)
    copy, other = ("".join(rng.choices("abcdefgh ", k=400)) for _ in "ab")
    frame = spark.createDataFrame([(i, copy) for i in range(6)] + [(9, other)], "doc_id long, text string")
    seen = []

    def judge(entries, judge=substring_dedup.answers):
        seen.append(entries.count())
        return judge(entries)

    monkeypatch.setattr(substring_dedup, "answers", judge)
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(frame, "doc_id", "text").collect()}
    assert got == {0: 0, 9: 0} | {i: 400 for i in range(1, 6)} and seen == [0]


def test_keys_of_phrase_starts_are_packed_without_loss():
    rng = np.random.default_rng(0)
    few, many = (np.unique(rng.integers(0, 1 << substring_dedup.KEY_BITS, n, dtype=np.uint64)) for n in (3, 300_000))
    for keys in (few, many, np.array([0, (1 << substring_dedup.KEY_BITS) - 1], np.uint64)):
        blobs = substring_dedup.packed(keys)
        assert np.concatenate([substring_dedup.unpacked(i, x) for i, x in enumerate(blobs)]).tolist() == keys.tolist()
    assert sum(map(len, substring_dedup.packed(many))) < 5 * len(many)


def test_pairs_are_judged_in_slices_that_carry_no_more_than_the_texts(spark, monkeypatch):
    monkeypatch.setattr(linking, "LEAST_CARRIED", 1)
    close = spark.createDataFrame([(a, b, 10) for a in range(40) for b in range(a + 1, 40)], "a long, b long, size int")
    judged = []

    def judge(some):
        judged.append(some.count())
        return some.where("(b - a) % 3 = 0")

    got = linking.in_slices(close, 2000, judge, Stages(spark))
    assert sorted(map(tuple, got.collect())) == [(a, b) for a in range(40) for b in range(a + 1, 40) if (b - a) % 3 == 0]
    assert len(judged) == 4 and sum(judged) == 780 and max(judged) < 2 * 780 / 4
    assert linking.in_slices(close.limit(0), 0, judge, Stages(spark)).count() == 0


def test_heads_of_lines_tell_unlike_lines_and_no_near_ones(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abcd \u00f1") for _ in range(rng.choice([1, 2, 5, 12, 40])))
        b = list(a)
        for _ in range(rng.randrange(len(a) // 4 + 2)):
            at = rng.randrange(len(b) + 1) if rng.random() < 0.5 else rng.choice([0, len(b)])
            b[at : at + rng.randrange(2)] = rng.choice(["", "a", "xy"])
        pairs.append((a, "".join(b)) if rng.random() < 0.5 else ("".join(b), a))
    unlike = [(prose(100 + i, 60), prose(400 + i, 60)) for i in range(200)]
    most = F.floor(F.greatest(F.length("left"), F.length("right")) * line_dedup.DIFFERENCE).cast("int")
    near = F.levenshtein("left", "right") <= F.col("most")
    for some in (pairs, unlike):
        frame = spark.createDataFrame(some, "left string, right string").withColumn("most", most)
        told = frame.select(line_dedup.heads_near("left", "right", "most").alias("heads"), near.alias("near")).collect()
        assert not [r for r in told if r["near"] and not r["heads"]]
        if some is unlike:
            assert sum(r["heads"] for r in told) < 20
        else:
            assert 300 < sum(r["near"] for r in told) < 1300


def test_bytes_covered_by_marked_strings():
    rng = np.random.default_rng(3)
    reach, length = substring_dedup.REACH, substring_dedup.LENGTH
    for size in (length, 60, 400):
        expected = np.zeros(size, bool)
        place, hit = [], []
        for _ in range(5):
            starts = rng.integers(0, size - length + 1)
            p, bits = int(starts) + int(rng.integers(0, reach)), 0
            for offset in range(reach):
                first = p - (reach - 1) + offset
                if 0 <= first <= size - length and rng.random() < 0.05:
                    bits |= 1 << offset
                    expected[first : first + length] = True
            place.append(p)
            hit.append(bits)
        got = substring_dedup.removed_bytes(size, np.array(place), np.array(hit))
        assert got.tolist() == expected.tolist()
    assert not substring_dedup.removed_bytes(70, np.zeros(0, np.int64), np.zeros(0, np.int64)).any()


def test_parse_is_written_without_what_can_be_computed_and_bitmaps_go(spark, docs, monkeypatch):
    written, sent = {}, []
    write, send = Stages.write, type(spark.sparkContext).broadcast
    monkeypatch.setattr(Stages, "write", lambda self, name, df, wide=False: written.setdefault(name, df.columns) and write(self, name, df, wide))
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(send(self, value)) or sent[-1])
    cleaned = substring_dedup.dedup_substrings(docs, "doc_id", "text")
    assert "around" in written["parse"] and "entry" not in written["parse"]
    assert len(sent) == 2
    for bits in sent:
        with pytest.raises(Exception, match="destroyed"):
            bits._jbroadcast.value()
    assert {r["doc_id"]: r["n_removed"] for r in cleaned.collect()}[2] > 0


def test_links_found_later_join_classes_not_ids(spark, monkeypatch):
    stages, rounds = Stages(spark), []
    components = linking.components
    monkeypatch.setattr(linking, "components", lambda links, stages: rounds.append(links.count()) or components(links, stages))
    # classes 0, 10, 20, 30 of ten each; ids from 100 on have none
    classes = spark.createDataFrame([(i, i // 10 * 10) for i in range(40)], "id long, class long")
    pairs = [(a, b) for a in range(10, 20) for b in range(20, 30)] + [(3, 7), (35, 101), (101, 102), (200, 201), (39, 400)]
    bad = (39, 400)
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = dict(map(tuple, linking.verified(classes, frame, lambda some: some.where(f"a <> {bad[0]}"), stages).collect()))
    assert rounds == [4]
    assert got == {i: {2: 1}.get(i // 10, i // 10) * 10 for i in range(40)} | {101: 30, 102: 30, 200: 200, 201: 200}
    # within classes there is nothing to follow
    same = linking.verified(classes, frame.where("a = 3"), lambda some: some, stages)
    assert same.count() == 40 and rounds == [4]


def test_further_keys_bring_no_pairs_together_that_differ_in_size(spark):
    stages, tried = Stages(spark), []
    members = spark.range(40).selectExpr("id AS key").selectExpr("0L AS key", "key AS id")
    none = spark.createDataFrame([], "id long, class long")

    def further(ids):
        return ids.select("id", F.array(*[(F.col("id") / 4).cast("long")] * linking.VALUES).alias("values"), F.pow(10, F.col("id") % 2).alias("size"))

    def verify(pairs):
        tried.extend(map(tuple, pairs.collect()))
        return pairs.where("false")

    near = order_minhash.near_sizes("size_a", "size_b", 0.8)
    linking.by_further_keys(members, further, none, verify, stages, near)
    assert set(tried) == {(a, a + 2) for a in range(38) if a % 4 < 2}


def test_unlike_lines_of_a_large_bucket_are_not_all_judged(spark, monkeypatch):
    """Every near line is found in one bucket that holds all lines, with far fewer pairs than it has."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(2000)]
    lines = [" ".join(rng.choices(vocabulary, k=30) + rng.choices(WORDS, k=10)) for _ in range(300)]
    near = [x.replace(" ", " q", 1) for x in lines[:60]]
    monkeypatch.setattr(line_dedup, "blocks", lambda hashes: [hashes.select(F.lit(7).cast("long").alias("key"), F.col("line").alias("id"))])
    judged = []
    similar = line_dedup.similar
    monkeypatch.setattr(line_dedup, "similar", lambda pairs, *more: judged.append(pairs.count()) or similar(pairs, *more))
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(near))], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(docs, "doc_id", "text").collect()}
    assert got == {1: 0, 2: 60}
    assert sum(judged) < 5 * 360


def test_lines_near_piece_by_piece_are_near(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PIECE", 8)
    rng = random.Random(3)
    pairs = []
    for _ in range(300):
        a = [rng.choice("abcd\u00e9") for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.choice("abcd\u00e9")] * rng.randrange(2)
        pairs.append(("".join(a), "".join(b)))
    frame = spark.createDataFrame(pairs, "left string, right string")
    frame = frame.withColumn("most", F.floor(F.greatest(F.length("left"), F.length("right")) * line_dedup.DIFFERENCE).cast("int"))
    told = frame.select(line_dedup.pieces_near("left", "right", "most").alias("pieces"), (F.levenshtein("left", "right") <= F.col("most")).alias("near")).collect()
    assert all(r["near"] for r in told if r["pieces"]) and sum(r["pieces"] for r in told) > 0.5 * sum(r["near"] for r in told)


def test_all_pairs_of_what_stays_large_are_near_in_size(spark):
    stages, tried = Stages(spark), []
    members = spark.range(40).select(F.lit(0).cast("long").alias("key"), "id", F.pow(10, F.col("id") % 2).alias("size"))
    none = spark.createDataFrame([], "id long, class long")

    def verify(pairs):
        tried.extend(map(tuple, pairs.collect()))
        return pairs.where("false")

    linking.across_classes(members, none, verify, stages, order_minhash.near_sizes("size_a", "size_b", 0.8))
    assert sorted(tried) == [(a, b) for a in range(40) for b in range(a + 2, 40, 2)]


def test_near_lines_of_a_large_bucket_that_share_no_word_are_found(spark, monkeypatch):
    """One bucket holds all lines; copies have another letter in each word, so no key over words brings them together."""
    lines = [" ".join(f"{w}{chr(97 + i)}{chr(97 + (7 * i + k) % 26)}xy" for k, w in enumerate(prose(700 + i, 25).split())) for i in range(24)]
    near = [" ".join("Q" + w[1:] for w in x.split()) for x in lines[:12]]
    monkeypatch.setattr(line_dedup, "blocks", lambda hashes: [hashes.select(F.lit(7).cast("long").alias("key"), F.col("line").alias("id"))])
    monkeypatch.setattr(linking, "PART", 10)
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(near))], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(docs, "doc_id", "text").collect()}
    assert got == {1: 0, 2: 12}


def test_a_pair_of_several_buckets_is_looked_at_once_and_by_its_facts(spark):
    stages, tried = Stages(spark), []
    members = spark.range(30).select(F.explode(F.array(*(F.lit(k).cast("long") for k in (5, 3, 9)))).alias("key"), "id")
    none = spark.createDataFrame([], "id long, class long")

    def verify(pairs):
        tried.extend(map(tuple, pairs.collect()))
        return pairs.where("false")

    linking.across_classes(members, none, verify, stages, "kind_a = kind_b AND size(keys_a) = 3", lambda ids: ids.withColumn("kind", F.col("id") % 3))
    assert sorted(tried) == [(a, b) for a in range(30) for b in range(a + 3, 30, 3)]


def test_near_texts_of_a_large_bucket_are_found_without_further_keys(spark, monkeypatch):
    """Texts that share a passage are in large buckets; further keys that no two have in common lose no link."""
    rng = random.Random(16)
    passage = prose(1, 60).split()
    texts = []
    for base in range(40):
        own = [f"{w}{base}" for w in prose(200 + base, rng.randint(40, 70)).split()]
        texts.append(own[:20] + passage + own[20:])
    for base in range(0, 40, 2):
        changed = list(texts[base])
        for at in rng.sample(range(len(changed)), len(changed) // 7):
            changed[at] = f"changed{base}"
        texts.append(changed)
    unlike = F.transform(F.sequence(F.lit(1), F.lit(linking.VALUES)), lambda i: F.xxhash64("id", i))
    monkeypatch.setattr(order_minhash, "further_values", lambda ids, words: words.join(ids, "id").select("id", unlike.alias("values"), F.col("n").alias("size")))
    monkeypatch.setattr(order_minhash, "SKETCHES", {5: 24})
    monkeypatch.setattr(order_minhash, "sketch", sketch_of_the_passage)
    monkeypatch.setattr(linking, "BLOCK", 16)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = defaultdict(list)
    for r in order_minhash.near_duplicates(frame, "doc_id", "text").collect():
        got[r["class_id"]].append(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted([i, 40 + i // 2] if i % 2 == 0 else [i] for i in range(40))


def sketch_of_the_passage(docs, doc_id, text):
    """One sketch value, which all texts share."""
    values = F.array(*[F.lit(7).cast("long")] * 24)
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tie"), F.unhex(F.md5(text)).alias("digest"), F.size(F.split(text, " ")).cast("long").alias("n_words"), values.alias("sketch"))


def test_marks_tell_no_near_texts_apart():
    rng, known = random.Random(8), order_minhash.WordHashes()
    told = 0
    for i in range(300):
        a = prose(900 + i, rng.choice([5, 20, 80, 400])).split()
        b = list(a)
        for _ in range(len(a) // rng.choice([2, 3, 4, 5, 6])):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = rng.choice([[], ["opal"], ["new"]])
        a_bits, b_bits = (np.unpackbits(order_minhash.bag_marks(order_minhash.hashes(x, known))) for x in (a, b))
        most = int(0.2 * max(len(a), len(b)) + 1e-9)
        near = order_minhash.banded_distance(a, b, most) <= most
        let = (a_bits != b_bits).sum() <= order_minhash.most_marks(0.8, np.array([len(a)]), np.array([len(b)]))[0]
        assert let or not near
        told += not let
        c = prose(5000 + i, len(a)).split()
        c_bits = np.unpackbits(order_minhash.bag_marks(order_minhash.hashes([x + "z" for x in c], known)))
        assert (a_bits != c_bits).sum() > order_minhash.most_marks(0.8, np.array([len(a)]), np.array([len(c)]))[0]
    assert told > 20


def test_a_repeated_kmer_leaves_the_others_as_they_are():
    words = order_minhash.hashes([f"w{i}" for i in range(40)], order_minhash.WordHashes())
    for k in (1, 3, 5):
        once, again = (set(order_minhash.labelled_kmers(x, k, plain=True).tolist()) for x in (words, np.concatenate([words, words[:k]])))
        assert once < again and len(again) - len(once) == k


def test_phrase_starts_are_settled_slice_by_slice(spark, docs, monkeypatch):
    """No slice writes what another does, and together they give what one slice of all gives."""
    want = sorted(map(tuple, substring_dedup.dedup_substrings(docs, "doc_id", "text").collect()), key=repr)
    written, write = {}, Stages.write
    monkeypatch.setattr(Stages, "write", lambda self, name, df, wide=False: written.setdefault(name, write(self, name, df, wide)))
    monkeypatch.setattr(Stages, "drop", lambda self, *names: None)
    monkeypatch.setattr(substring_dedup, "ENTRIES", 5)
    for slices in (1, 4):
        written.clear()
        monkeypatch.setattr(substring_dedup, "SLICES", slices)
        got = sorted(map(tuple, substring_dedup.dedup_substrings(docs, "doc_id", "text").collect()), key=repr)
        assert got == want and any(r[3] for r in got)
        number = {n: written[n].count() for n in written if n.startswith("found")}
        assert len(number) == slices
        if slices == 1:
            whole = number["found0"]
    assert sum(number.values()) == whole and max(number.values()) < 0.6 * whole


def test_lines_that_further_keys_do_not_bring_together_go_in_the_pipeline(spark, monkeypatch):
    import corpus_pipeline

    lines = [" ".join(f"{w}{chr(97 + i)}{chr(97 + (7 * i + k) % 26)}xy" for k, w in enumerate(prose(800 + i, 25).split())) for i in range(12)]
    near = [" ".join("Q" + w[1:] for w in x.split()) for x in lines[:6]]
    monkeypatch.setattr(line_dedup, "blocks", lambda hashes: [hashes.select(F.lit(7).cast("long").alias("key"), F.col("line").alias("id"))])
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(lines + near)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()) == list(range(12))


def test_what_further_keys_put_into_large_buckets_is_left_to_every(spark):
    stages, got = Stages(spark), {}
    members = spark.range(40).select((F.col("id") % 2).alias("key"), "id")

    def every(members, classes):
        got.update((r["key"], sorted(r["ids"])) for r in members.groupBy("key").agg(F.collect_list("id").alias("ids")).collect())
        return classes

    def further(ids):  # all ids of half the range are alike
        return ids.select("id", F.array(*[(F.col("id") / 20).cast("long")] * linking.VALUES).alias("values"))

    linking.classes_of(linking.candidate_pairs([members], stages), lambda pairs: pairs.where("false"), stages, further, every=every)
    assert got.pop(0) == list(range(0, 40, 2)) and got.pop(1) == list(range(1, 40, 2))
    halves = list(map(tuple, got.values()))
    assert len(halves) == 2 * linking.LEVELS[0][1] and set(halves) == {tuple(range(20)), tuple(range(20, 40))}
