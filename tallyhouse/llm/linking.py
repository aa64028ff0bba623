"""Candidate pairs from buckets, and classes from links, with all pairs of a large bucket that can matter."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages, union_all

#: Buckets up to this size emit all pairs, so at most this many for each row.
SMALL_BUCKET = 8
#: Rows of a bucket that meet others at once.
PART = 200
#: Rows of a bucket whose marks are compared at once, and how often each meets its nearest of another class before all others.
BLOCK = 1000
ROUNDS = 1
#: Pairs carry at least this much of their texts to each other at once, in what sizes are counted in.
LEAST_CARRIED = 1 << 26
#: Values that ``further`` gives for an id, and for each level how many of them are one key and how many such keys it takes.
VALUES = 64
LEVELS = ((4, 16), (6, 40))


class Candidates(NamedTuple):
    """Distinct ``pairs`` (a, b, led: whether of large buckets only), a < b, and the ``members`` (key, id) of the large buckets."""

    pairs: DataFrame
    members: DataFrame


def candidate_pairs(members: list[DataFrame], stages: Stages) -> Candidates:
    """Pairs from ``members`` (key, id; an id once per key, a key in one frame only).

    In a small bucket all pairs; in a larger one every member with three leaders: the
    smallest id, the largest, and the one with the smallest hash. The number of pairs
    thus follows the number of members. ``classes_of`` goes on with what these pairs
    leave in several classes. One frame is looked through after the other, and its shuffle
    files are released.
    """
    found = []
    for some in members:
        found.append(bucket_pairs(some, stages))
        stages.drop("ends", "shared", "large", "middle")
        stages.release()
    pairs, large = (union_all(list(x)) for x in zip(*found, strict=True))
    return Candidates(stages.write("pairs", pairs.groupBy("a", "b").agg(F.min("led").alias("led"))), large)


def bucket_pairs(members: DataFrame, stages: Stages) -> Candidates:
    """``candidate_pairs`` of one frame."""
    # most keys have one id; what follows reads only the others
    ends = stages.write("ends", members.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last"))
    shared = stages.write("shared", members.join(ends, "key"))
    sizes = shared.groupBy("key").agg(F.count("*").alias("n"), F.min(F.xxhash64("id")).alias("place"))
    large = stages.write("large", sizes.where(F.col("n") > SMALL_BUCKET))
    middle = shared.withColumn("place", F.xxhash64("id")).join(large, ["key", "place"]).groupBy("key").agg(F.min("id").alias("middle"))
    led = shared.join(stages.write("middle", middle), "key")
    small = shared.join(large, "key", "left_anti").select("key", "id")
    both = small.select("key", F.col("id").alias("a")).join(small.select("key", F.col("id").alias("b")), "key").where("a < b")
    leaders = F.explode(F.array("first", "last", "middle"))
    pairs = led.select(leaders.alias("a"), F.col("id").alias("b"), F.lit(True).alias("led")).where("a <> b").unionByName(both.select("a", "b", F.lit(False).alias("led")))
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("led").alias("led"))
    pairs = stages.write("some_pairs", pairs)
    return Candidates(pairs, stages.write("members", led.select("key", "id")))


def classes_of(
    candidates: Candidates,
    verify: Callable[[DataFrame], DataFrame],
    stages: Stages,
    further: Callable[[DataFrame], DataFrame] | None = None,
    near: str = "true",
    every: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, class) of all ids in verified pairs (a, b).

    First every id is verified against the smallest one it was paired with. That links
    most of a large class, and pairs within what is linked need no look any more; then
    all pairs that lead elsewhere are verified. Then all pairs of different classes that
    share a large bucket are: by ``every`` (members, classes), which gives the classes
    after that and knows which pairs need no look, or by ``across_classes``. The pairs
    with leaders are among those, so ``every`` stands for them too.

    ``further`` keys come before that: the first level of ``by_further_keys`` links most of
    what is alike, and what it puts into large buckets is left to ``every`` too. Without
    ``every``, they and what they leave in large buckets are all there is, which misses
    links; that is for callers that can do with most of them. ``near`` is a condition on
    the sizes that ``further`` gives, size_a and size_b, without which no pair is verified.
    """
    pairs = candidates.pairs.select("a", "b")
    first = stages.write("first", pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = stages.write("links_first", verify(first))
    classes = components(links, stages)
    others = candidates.pairs.where("NOT led").select("a", "b") if further or every else pairs
    rest = with_classes(others.join(first, ["a", "b"], "left_anti"), classes).where("class_a <> class_b").select("a", "b")
    classes = verified(classes, rest, verify, stages)
    stages.drop("first")
    stages.release()
    members = candidates.members
    if further:
        left, classes = by_further_keys(members, further, classes, verify, stages, near, LEVELS[:1] if every else LEVELS)
        members = members.unionByName(left.select("key", "id")) if every else left
    return every(members, classes) if every else across_classes(members, classes, verify, stages, near)


def in_slices(close: DataFrame, held: int, judge: Callable[[DataFrame], DataFrame], stages: Stages) -> DataFrame:
    """``judge`` of all pairs ``close`` (a, b, and the size of the text that is carried to the other), slice after slice.

    Pairs can carry many times the texts there are. A slice carries about as much as ``held``,
    the size of all texts, and its shuffle files are released before the next; so disk
    follows the texts however many pairs there are.
    """
    close = stages.write("close", close)
    carried = close.agg(F.sum(F.col("size").cast("double"))).first()[0]
    if carried is None:
        return close.select("a", "b")
    number = max(1, math.ceil(carried / max(held, LEAST_CARRIED)))
    judged = []
    for i in range(number):
        some = close.where(F.pmod(F.xxhash64("a", "b"), F.lit(number)) == i).select("a", "b")
        judged.append(stages.write("links_some", judge(some)))
        stages.release()
    stages.drop("close")
    return union_all(judged)


def by_further_keys(
    members: DataFrame,
    further: Callable[[DataFrame], DataFrame],
    classes: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    stages: Stages,
    near: str = "true",
    levels: tuple[tuple[int, int], ...] = LEVELS,
) -> tuple[DataFrame, DataFrame]:
    """Put the ids of large buckets that hold several classes into smaller buckets, level by level; links join ``classes`` (id, class).

    ``further`` gives (id, values, and size if ``near`` asks for it) of ids: VALUES numbers, of which alike ids have two thirds
    or more in common. Then 0.97 of alike pairs meet at the first level, and as many at the second. A level's keys are some of them together. In a small bucket all pairs of
    different classes are verified. In a large one all members are verified against the smallest id
    if it is of another class, and go to the next of the ``levels``, whose keys are longer.
    Pairs that meet in no small bucket and not with the smallest id are left to the caller.
    Returns the members (key, id, size) of buckets that are large at the last level, and the classes.
    """
    values = None
    for level, subsets in enumerate(key_places()[: len(levels)]):
        labelled = members.join(classes, "id", "left").select("key", "id", F.coalesce("class", "id").alias("class"))
        several = labelled.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("key")
        ids = stages.write("open", labelled.join(several, "key").groupBy("id").agg(F.min("class").alias("class")))
        if ids.isEmpty():
            stages.drop("open")
            return labelled.where("false").select("key", "id"), classes
        if values is None:
            values = further(ids.select("id"))
            values = stages.write("values", values if "size" in values.columns else values.withColumn("size", F.lit(0)))
        keys = [F.xxhash64(F.lit(level), F.lit(number), *(F.col("values")[i] for i in places)) for number, places in enumerate(subsets)]
        entries = values.join(ids, "id").select("id", "class", "size", F.explode(F.array(*keys)).alias("key"))
        head = [F.min("id").alias("head"), F.min_by("class", "id").alias("class_a"), F.min_by("size", "id").alias("size_a")]
        sizes = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"), *head)
        sizes = stages.write("sizes", sizes.where("low < high").drop("low", "high"))
        shared = stages.write("sharing", entries.join(sizes, "key"))
        large = shared.where(F.col("n") > SMALL_BUCKET)
        led = large.withColumnRenamed("size", "size_b").where(f"class <> class_a AND {near}").select(F.col("head").alias("a"), F.col("id").alias("b"))
        small = shared.where(F.col("n") <= SMALL_BUCKET).select("key", F.col("id").alias("a"), "class", F.col("size").alias("size_a"))
        other = small.select("key", F.col("a").alias("b"), F.col("class").alias("class_b"), F.col("size_a").alias("size_b"))
        met = small.join(other, "key").where(f"a < b AND class <> class_b AND {near}")
        members = stages.write("members", large.select("key", "id", "size"))
        classes = verified(classes, met.select("a", "b").unionByName(led).distinct(), verify, stages)
        stages.drop("open", "sizes", "sharing")
        stages.release()
    return members, classes


def key_places() -> list[list[list[int]]]:
    """For each level the places of VALUES that each of its keys is made of, every place about equally often."""
    rng = random.Random(0)
    levels = []
    for width, number in LEVELS:
        places: list[int] = []
        while len(places) < width * number:
            places += rng.sample(range(VALUES), VALUES // width * width)
        levels.append([places[i * width : (i + 1) * width] for i in range(number)])
    return levels


def with_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) and class_a, class_b; an id without a class is its own."""
    for x in "ab":
        of_x = classes.select(F.col("id").alias(x), F.col("class").alias(f"class_{x}"))
        pairs = pairs.join(of_x, x, "left").withColumn(f"class_{x}", F.coalesce(f"class_{x}", x))
    return pairs


def verified(classes: DataFrame, pairs: DataFrame, verify: Callable[[DataFrame], DataFrame], stages: Stages) -> DataFrame:
    """(id, class) by ``classes`` (id, class) and the links among ``pairs`` (a, b).

    Only links between classes are followed, from class to class, not from id to id.
    """
    tried = stages.write("tried", pairs)
    between = with_classes(verify(tried), classes).where("class_a <> class_b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    between = stages.write("between", between.distinct())
    stages.drop("tried")
    if not between.isEmpty():
        # ids that had no class are among the joined as their own
        joined = components(between, stages)
        into = joined.select(F.col("id").alias("class"), F.col("class").alias("into"))
        moved = classes.join(into, "class", "left").select("id", F.coalesce("into", "class").alias("class"))
        classes = stages.write("classes", moved.unionByName(joined.join(classes, "id", "left_anti")))
    stages.drop("between")
    stages.release()
    return classes


def across_classes(
    members: DataFrame,
    classes: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    stages: Stages,
    near: str = "true",
    facts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, class) by ``classes`` (id, class) and by all pairs of different classes that share a key of ``members``.

    Exact, so quadratic in what a bucket holds in different classes; pairs within a class
    are not formed. A large bucket is cut into parts, and each two parts meet by themselves,
    so no task holds more than PART rows of a bucket. Where ``members`` have a size, only
    pairs that are ``near`` in it are formed. ``facts`` gives (id, and more columns) of ids
    (id), and ``near`` may then ask for these too, as column_a and column_b; it must hold
    for every pair that ``verify`` lets pass. A pair that shares several keys is looked at once.
    """
    own = [c for c in members.columns if c not in ("key", "id")]
    open_, several = open_members(members, classes, stages)
    if open_ is None:
        return classes
    placed = open_.join(several, "key")
    once = "true"
    if facts:
        told = stages.write("facts", with_keys(open_, facts), wide=True)
        own, once = own + [c for c in told.columns if c != "id"], "array_min(array_intersect(keys_a, keys_b)) = key"
        placed = placed.join(told, "id")
    parts = F.ceil(F.col("n") / PART).cast("int")
    placed = placed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def side(x: str, part: str, other: str, others: Column) -> DataFrame:
        named = (F.col(c).alias(f"{c}_{x}") for c in ("class", *own))
        return placed.select("key", F.col("id").alias(x), *named, F.col("part").alias(part), F.explode(others).alias(other))

    left = side("a", "i", "j", F.sequence("part", F.col("parts") - 1))
    right = side("b", "j", "i", F.sequence(F.lit(0), "part"))
    met = left.join(right, ["key", "i", "j"]).where(f"class_a <> class_b AND (i < j OR a < b) AND {once} AND {near if own else 'true'}")
    classes = verified(classes, met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), verify, stages)
    stages.drop("open", "several", *["facts"] * bool(facts))
    stages.release()
    return classes


def in_blocks(
    members: DataFrame, classes: DataFrame, verify: Callable[[DataFrame], DataFrame], stages: Stages, facts: Callable[[DataFrame], DataFrame], most: Callable
) -> DataFrame:
    """What ``across_classes`` gives, for buckets of many alike ids and ids that a set of bits tells apart.

    ``facts`` gives (id, size, marks) of ids (id), ``most(sizes, sizes)`` in how many of the
    marks' bits near ids of two sizes can differ, less than 0 if they cannot be near. All
    pairs of different classes are compared so, block by block, and those that may be near
    are verified. In ROUNDS before that each id takes only the nearest of another class, which
    joins most of what is alike, so that few pairs are left between classes.
    """
    told = None
    for turn in range(ROUNDS + 1):
        open_, several = open_members(members, classes, stages)
        if open_ is None:
            break
        if told is None:
            told = stages.write("facts", with_keys(open_, facts).withColumn("keys", F.array_sort("keys")), wide=True)
        parts = several.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
        placed = open_.select("key", "id", "class").join(parts, "key").join(told, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        cells = placed.select("key", "id", "class", "size", "marks", "keys", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        cells = cells.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
        pairs = cells.groupBy("key", "i", "j").applyInArrow(meet(most, turn < ROUNDS), "a long, b long")
        classes = verified(classes, pairs.distinct(), verify, stages)
        stages.drop("open", "several")
        stages.release()
    if told is not None:
        stages.drop("facts")
    return classes


def meet(most: Callable, nearest: bool) -> Callable[[pa.Table], pa.Table]:
    """For a block of ``in_blocks`` the pairs of different classes that may be near, each at its smallest key; or every id's ``nearest``."""

    def of(cell: pa.Table) -> pa.Table:
        key, i, j = (cell.column(c)[0].as_py() for c in ("key", "i", "j"))
        cell = cell.combine_chunks()
        ids, kinds, sizes, part = (cell.column(c).to_numpy() for c in ("id", "class", "size", "part"))
        marks = np.frombuffer(b"".join(cell.column("marks").to_pylist()), np.uint64).reshape(len(ids), -1)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        apart = np.empty((len(left), len(right)), np.int64)
        for row, at in enumerate(left):
            apart[row] = np.bitwise_count(marks[right] ^ marks[at]).sum(axis=1, dtype=np.int64)
        limit = most(sizes[left][:, None], sizes[right][None, :])
        may = (apart <= limit) & (kinds[left][:, None] != kinds[right][None, :])
        if i == j and not nearest:
            may &= ids[left][:, None] < ids[right][None, :]
        if nearest:
            far = np.where(may, apart - limit, 1)
            found = {(row, at) for row, at in enumerate(far.argmin(axis=1).tolist()) if far[row, at] < 1} if far.size else set()
            if i != j and far.size:
                found |= {(row, at) for at, row in enumerate(far.argmin(axis=0).tolist()) if far[row, at] < 1}
        else:
            keys = cell.column("keys").to_pylist()
            sets = {at: set(keys[at]) for at in {*left[may.any(axis=1)].tolist(), *right[may.any(axis=0)].tolist()}}
            found = [(row, at) for row, at in zip(*(x.tolist() for x in np.nonzero(may)), strict=True) if min(sets[left[row]] & sets[right[at]]) == key]
        pairs = sorted({tuple(sorted((int(ids[left[row]]), int(ids[right[at]])))) for row, at in found})
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return of


def open_members(members: DataFrame, classes: DataFrame, stages: Stages) -> tuple[DataFrame | None, DataFrame | None]:
    """Of ``members`` (key, id, and more) those of buckets with several ``classes`` (id, class), with their class, and (key, n) of these buckets; None where there are none."""
    labelled = stages.write("labelled", members.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id")))
    sizes = labelled.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
    several = stages.write("several", sizes.where("low < high").select("key", "n"))
    if several.isEmpty():
        stages.drop("labelled", "several")
        return None, None
    found = stages.write("open", labelled.join(several.select("key"), "key", "left_semi"))
    stages.drop("labelled")
    return found, several


def with_keys(members: DataFrame, facts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``facts`` gives of the ids of ``members`` (key, id), and all their keys."""
    keys = members.groupBy("id").agg(F.collect_list("key").alias("keys"))
    return facts(keys.select("id")).join(keys, "id")


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(id, class) of every id in ``links`` (a, b): the class is its component's smallest id.

    Everyone takes the smallest class among its neighbours, then its class's class,
    until nothing changes. Every round is a written table.
    """
    both = stages.write("links", links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stages.write("labels0", both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("class")))
    turn = 0
    while True:
        turn += 1
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
        taken = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("class").alias("was"), F.least("class", "near").alias("class"))
        above = labels.select(F.col("id").alias("class"), F.col("class").alias("above"))
        moved = stages.write(
            f"labels{turn}",
            taken.join(above, "class").select("id", F.least("class", "above").alias("class"), (F.least("class", "above") < F.col("was")).alias("moved")),
        )
        stages.drop(f"labels{turn - 1}")
        labels = moved.select("id", "class")
        if not moved.where("moved").limit(1).count():
            stages.drop("links")
            return labels
