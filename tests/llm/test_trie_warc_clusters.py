"""Prefix tries, WARC bundles and centroid clustering on awkward rows, and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tallyhouse.llm import centroid_clustering, prefix_trie, warc

TURNS = "conv_id long, turn long, role string, text string, path string, shard string, key string"


def tried(spark, rows):
    own = prefix_trie.own_turns(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS), "conv_id", "turn", "role", "text")
    found = prefix_trie.trie(prefix_trie.rebuild(own))
    return Counter(tuple(r[c] for c in sorted(found.columns)) for r in found.collect()), sorted(found.columns)


def brute_trie(rows):
    """Nodes from the definition: every start of every rebuilt conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(role, text) for _, role, _, text in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    out = Counter()
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        row = {
            "conv_id": min(convs),
            "depth": len(p),
            "parent_conv_id": min(members[p[:-1]]) if p else None,
            "n_convs": len(convs),
            "n_children": sum(len(q) == len(p) + 1 for q in below),
            "n_leaves": len(childless),
            "saved_tokens": sum((len(members[q]) - 1) * words[q] for q in below),
            "ends_sha256": hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        }
        out[tuple(row[c] for c in sorted(row))] += 1
    return out


def conversations(seed, n, hot):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 4 * n), n):
        if rng.random() < hot:
            rows += [(c, t, "user", f"the same {t}") for t in range(4)]
            continue
        for t in range(rng.randrange(1, 6)):
            turn = rng.choice([t, t, t, None, 2])
            rows.append((c, turn, rng.choice(["user", "user", "bot", None]), rng.choice(["a b", "c", "", None, "a  b c\n"])))
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 0.0), (2, 0.4)])
def test_trie_against_brute_force(spark, seed, hot):
    rows = [*conversations(seed, 150, hot), (None, 0, "user", "lost"), (7, 0, "user", "x" * 300_000)]
    rows += rows[:3]
    got, columns = tried(spark, rows)
    assert columns == sorted([c.split()[0] for c in prefix_trie.NODE.split(", ")] + ["ends_sha256"])
    assert got == brute_trie(rows)


def test_trie_of_many_shards(spark, monkeypatch):
    """Small shards, short lists and a salted join give the same nodes."""
    monkeypatch.setattr(prefix_trie, "TURNS_PER_SHARD", 20)
    monkeypatch.setattr(prefix_trie, "IDS_PER_LIST", 2)
    monkeypatch.setattr(prefix_trie, "MOST_BROADCAST", 0)
    rows = conversations(3, 200, 0.5)
    assert tried(spark, rows)[0] == brute_trie(rows)


def test_trie_of_nothing_and_of_one(spark):
    assert tried(spark, [])[0] == Counter()
    # the first turn is replaced by that of an absent conversation, so none is left
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    got, columns = tried(spark, [(lone, 0, "user", "hello")])
    assert got == brute_trie([(lone, 0, "user", "hello")]) and list(got)[0][columns.index("depth")] == 0


PAGES = "page_id long, url string, html string, key string, digest string, first long"


def page_rows():
    rng = random.Random(5)
    body = ["".join(rng.choice("abc <>é\r\n") for _ in range(rng.choice([50, 99, 130, 900]))) for _ in range(30)]
    rows = [(i, f"http://x.org/{i}", body[rng.randrange(30)] if i % 3 else body[29] + "x" * 100) for i in range(120)]
    rows += [(200, None, None), (201, "http://a/\r\nX: y", ""), (202, "u", "WARC/1.1\r\n\r\n" * 40), (203, "u", "\r\n\r\n"), (None, "u", rows[0][2])]
    rows += [rows[0], rows[1], (204, "u", "y" * 3_000_000)]
    return [(*r, "k", "d", 1) for r in rows]


def expected_pages(rows):
    raw = [(r[0], (r[2] or "").encode()) for r in rows]
    first = {}
    for page, body in raw:
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    out = Counter()
    for page, body in raw:
        own = page if len(body) < 100 else first.get(body, page)
        out[page, len(body), hashlib.sha256(body).hexdigest(), "response" if own == page else "revisit", None if own == page else own] += 1
    return out


def archived(spark, rows, tmp_path):
    path = f"{tmp_path}/archives"
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), "page_id", "url", "html", path)
    return path


def test_archives_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 6_000)
    rows = page_rows()
    path = archived(spark, rows, tmp_path)
    read = warc.read_archives(spark, path).collect()
    number = {None: None} | {str(r[0]): r[0] for r in rows}
    got = Counter((number[r["page_id"]], r["payload_bytes"], r["payload_digest"], r["record_type"], number[r["refers_to"]]) for r in read)
    assert got == expected_pages(rows)
    bodies = defaultdict(set)
    for r in rows:
        bodies[r[0]].add((r[2] or "").encode())
    assert all(bytes(r["payload"]) in bodies[number[r["page_id"]]] for r in read if r["record_type"] == "response")
    assert {r["target_uri"] for r in read if r["page_id"] in ("200", "201")} == {None, "http://a/%0D%0AX: y"}
    assert len(set(tmp_path.glob("archives/bundle=*/*"))) > 3


def test_files_are_plain_zstandard(spark, tmp_path):
    rows = page_rows()
    path = archived(spark, rows, tmp_path)
    text = b""
    for file in sorted(tmp_path.glob("archives/bundle=*/part-*")):
        content = file.read_bytes()
        assert content.endswith(warc.SEEK_END)
        text += zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert text.count(b"WARC-Record-ID: ") == len(rows)
    assert warc.index_archives(spark, path).count() == len(rows)


@pytest.mark.parametrize("listed", [0, 1_000])
def test_single_records_by_index(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    monkeypatch.setattr(warc, "MOST_LISTED", listed)
    path = archived(spark, page_rows(), tmp_path)
    index = warc.index_archives(spark, path)
    whole = {r["record_id"]: r for r in warc.read_archives(spark, path).collect()}
    wanted = [r["record_id"] for r in index.collect()][::7]
    got = {r["record_id"]: r for r in warc.fetch(spark, path, index.where(F.col("record_id").isin(wanted))).collect()}
    assert set(got) == set(wanted) and all(got[i] == whole[i] for i in wanted)


def test_a_changed_payload_is_an_error():
    row = {"page_id": "1", "uri": "u", "digest": hashlib.sha256(b"abc").hexdigest(), "size": 3, "first": None, "revisit": False, "payload": b"abd"}
    with pytest.raises(ValueError, match="differ"):
        warc.parse_record(warc.warc_record(row)[1])


def test_archives_of_nothing_and_hot_payloads(spark, tmp_path, monkeypatch):
    path = archived(spark, [], tmp_path)
    assert warc.read_archives(spark, path).count() == 0 and warc.index_archives(spark, path).count() == 0
    monkeypatch.setattr(warc, "HOT_ROWS", 3)
    monkeypatch.setattr(warc, "MOST_HOT", 20)
    rows = page_rows()
    path = archived(spark, rows, tmp_path / "hot")
    kinds = warc.read_archives(spark, path).groupBy("record_type").count().collect()
    expected = Counter()
    for row, n in expected_pages(rows).items():
        expected[row[3]] += n
    assert {r["record_type"]: r["count"] for r in kinds} == expected


VECTORS = "vec_id long, embedding array<float>, cluster string, distance string, v string"


def brute_clusters(rows, k, rounds, dimensions, scale, seed):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for j, own in groups.items():
            centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return Counter((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centroids


@pytest.mark.parametrize("size", [1.0, 3e6])
def test_clusters_against_brute_force(spark, size):
    rng = random.Random(4)
    rows = [(i, [size * rng.randint(-4, 4) / 8 for _ in range(5)]) for i in range(200)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5), (304, [1.0]), (305, [])]
    rows += [(None, [size / 3] * 5), rows[0], rows[0], (0, [0.25] * 5)]
    frame = spark.createDataFrame([(*r, "c", "d", "v") for r in rows], VECTORS)
    found, centroids = centroid_clustering.cluster(frame, "vec_id", "embedding", k=7, rounds=3, dimensions=5)
    got = found.collect()
    expected, ends = brute_clusters(rows, 7, 3, 5, 256, 2)
    assert centroids == ends
    assert Counter((r["vec_id"], r["cluster"], r["distance"]) for r in got) == expected
    by_cluster = Counter()
    for (_, cluster, distance), n in expected.items():
        by_cluster[cluster] += n * distance
    most = centroid_clustering.LARGEST
    total = min(sum(by_cluster.values()), most)
    assert all(r["cluster_inertia"] == min(by_cluster[r["cluster"]], most) and r["inertia"] == total for r in got)


def test_clusters_of_few_none_and_extreme_vectors(spark):
    def run(rows, k):
        return centroid_clustering.cluster(spark.createDataFrame([(*r, "c", "d", "v") for r in rows], VECTORS), "vec_id", "embedding", k=k, rounds=2, dimensions=2)

    found, centroids = run([], 3)
    assert found.collect() == [] and centroids == []
    found, centroids = run([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], 5)
    assert len(centroids) == 2 and {r["distance"] for r in found.collect()} == {0}
    # differences beyond 64 bits count as the largest number
    found, _ = run([(1, [3e38, 0.0]), (2, [-3e38, 0.0])], 1)
    assert {r["distance"] for r in found.collect()} == {centroid_clustering.LARGEST}
