import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import shaping as S
from tallyhouse.operators.grouping import aggregate_with_distinct
from tallyhouse.operators.ordering import in_ranges, repeat_rows, with_neighbour, with_rank
from tallyhouse.operators.series import date_spine, generate_series
from tallyhouse.operators.violations import mutually_exclusive_ranges, sequential_values


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def make(spark):
    return lambda schema, data: spark.createDataFrame(data, schema)


def test_series(spark):
    assert [r[0] for r in generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        generate_series(spark, 0)


def test_date_spine_stops_before_the_end(spark):
    days = [str(r[0]) for r in date_spine(spark, "day", "2018-01-01", "2018-01-10").collect()]
    assert days == [f"2018-01-0{i}" for i in range(1, 10)]
    months = [str(r[0]) for r in date_spine(spark, "month", "2018-01-31", "2018-04-01").collect()]
    assert months == ["2018-01-31", "2018-02-28", "2018-03-31"]
    assert date_spine(spark, "hour", "2018-01-01 00:00:00", "2018-01-02 00:00:00").count() == 24
    # 2018-01-07 is the Sunday in between
    assert date_spine(spark, "week", "2018-01-06", "2018-01-07").count() == 1
    assert date_spine(spark, "week", "2018-01-07", "2018-01-08").count() == 0
    with pytest.raises(ValueError):
        date_spine(spark, "eon", "2018-01-01", "2018-01-02")


def test_deduplicate(make):
    df = make("user_id int, event string, version int", [(1, "play", 1), (1, "play", 2), (2, "pause", 1)])
    kept = S.deduplicate(df.filter("user_id = 1"), ["user_id"], [F.col("version").desc_nulls_last()])
    assert rows(kept) == [(1, "play", 2)]
    nulls = make("k int, v int", [(1, None), (1, 3), (None, 5), (None, 4)])
    assert rows(S.deduplicate(nulls, ["k"], ["v"])) == [(1, 3), (None, 4)]
    plan = S.deduplicate(df, ["user_id"], ["version"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "candidates must be pruned before the shuffle"


def test_pivot(make):
    df = make("size string, color string", [("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")])
    values = S.value_list(df, "color", 10, order_by=[F.col("value")])
    assert values == ["blue", "blue's", "red"]
    wide = df.groupBy("size").agg(*S.pivot("color", values, prefix="n ", slugs=True))
    assert wide.columns == ["size", "n_blue", "n_blues", "n_red"]
    assert rows(wide) == [("M", 0, 0, 1), ("S", 1, 1, 1)]
    above = df.groupBy().agg(*S.pivot("color", ["blue"], cmp="!=", distinct=True, agg="count"))
    assert above.first()[0] == 2


def test_slugs():
    assert S.slugify("A-b C!") == "a_b_c"
    assert S.slugify("1st") == "_1st"
    assert S.slugify("") == ""


def test_unpivot_keeps_nulls_and_spells_booleans(make):
    df = make("id int, flag boolean, status string", [(1, True, "a"), (2, None, None)])
    assert rows(S.unpivot(df, exclude=["ID"], remove=["none"], field_name="prop", value_name="val")) == [
        (1, "flag", "true"), (1, "status", "a"), (2, "flag", None), (2, "status", None),
    ]
    assert S.unpivot(df, exclude=["id"], remove=["STATUS"]).columns == ["id", "field_name", "value"]


def test_union_relations(make):
    a = make("id int, name string, favorite_number int", [(1, "drew", 1), (2, "bob", 2)])
    b = make("id bigint, favorite_color string", [(1, "green")])
    both = S.union_relations({"a": a, "b": b})
    assert both.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(both) == [("a", 1, "drew", 1, None), ("a", 2, "bob", 2, None), ("b", 1, None, None, "green")]
    assert dict(both.dtypes)["id"] == "int"
    assert dict(S.union_relations({"a": a, "b": b}, {"id": "string"}).dtypes)["id"] == "string"
    assert S.union_relations({"a": a, "b": b}, include=["ID"], source_column=None).columns == ["id"]
    assert S.union_relations({"a": a, "b": b}, exclude=["NAME"], where="id = 1").count() == 2
    with pytest.raises(ValueError):
        S.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        S.union_relations({"a": a}, include=["nothing"])


def test_union_by_pattern(spark, make):
    for day in ("01", "02", "03"):
        make("user_id int, event string", [(int(day), "play"), (9, "pause")]).createOrReplaceTempView(f"ev_201801{day}")
    assert S.tables_like(spark, "default", "EV_%", "%03") == ["ev_20180101", "ev_20180102"]
    assert S.union_by_prefix(spark, "default", "ev_").count() == 6
    assert S.union_by_pattern(spark, "default", "%20180102").count() == 2
    with pytest.raises(ValueError):
        S.union_by_prefix(spark, "default", "nothing_")


def test_union_relations_names_differ_in_case(make):
    both = S.union_relations({"a": make("ID int, x string", [(1, "p")]), "b": make("id int, y string", [(2, "q")])}, {"id": "bigint"})
    assert both.dtypes[1] == ("ID", "bigint") and both.columns[1:] == ["ID", "x", "y"]
    assert sorted(r["ID"] for r in both.collect()) == [1, 2]


def test_pivot_over_distinct_values(make):
    df = make("k string, c string, v int", [("a", "x", 1), ("a", "x", 1), ("a", "x", 4), ("a", "y", None), ("b", "y", 7)])
    for agg, expected in [("avg", [("a", 2.5, None), ("b", None, 7.0)]), ("max", [("a", 4, None), ("b", None, 7)]), ("sum", [("a", 5, None), ("b", None, 7)])]:
        columns = S.pivot("c", ["x", "y"], agg, then_value=F.col("v"), else_value=None, distinct=True)
        assert sorted(tuple(r) for r in df.groupBy("k").agg(*columns).collect()) == expected
    with pytest.raises(ValueError):
        S.pivot("c", ["x"], "stddev", distinct=True)


def test_star_and_group_by(make):
    df = make("field_1 string, field_2 string, field_3 int", [("a", "b", 1), ("a", "b", 2), ("c", "e", 4)])
    assert df.select(*S.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*S.star(df, prefix="p_", suffix="_s")).columns == ["p_field_1_s", "p_field_2_s", "p_field_3_s"]
    both = df.alias("l").join(df.alias("r"), F.col("l.field_1") == F.col("r.field_1"))
    chosen = both.select(*S.star(df, ["field_2"], relation_alias="l"), *S.star(df, ["field_2"], prefix="r_", relation_alias="r"))
    assert chosen.columns == ["field_1", "field_3", "r_field_1", "r_field_3"]
    assert chosen.count() >= df.count()
    assert rows(S.group_by_first(df, 2).agg(F.sum("field_3"))) == [("a", "b", 3), ("c", "e", 4)]


def test_nullcheck(make):
    df = make("a string, b string, c int", [("", "x", 3), ("y", "", None)])
    assert rows(S.nullcheck_table(df)) == [("y", None, None), (None, "x", 3)]


def test_column_values(make):
    df = make("f string, c string", [("a", "left"), ("g", "left"), ("g", "right"), ("b", "right")])
    assert [r.value for r in S.column_values(df, "f").collect()] == ["g", "a", "b"]
    assert [r.value for r in S.column_values(df, "f", max_records=1).collect()] == ["g"]
    assert S.value_list(df, "f", 10, where="c = 'left'", order_by=[F.col("value").desc()]) == ["g", "a"]
    assert S.value_list(df, "f", 10, default=["z"], where="false") == ["z"]


def test_single_value(make):
    df = make("v int", [(7,)])
    assert df.filter(F.col("v") == S.single_value(df)).count() == 1
    empty = df.filter("false")
    assert df.select(S.single_value(empty, 19).alias("x")).first().x == 19
    assert df.select(S.single_value(make("v int", [(None,)]), 19).alias("x")).first().x is None


def test_distinct_counts_apart(make):
    data = [(k, random.Random(i).choice([1, 2, 3, None]), i) for i in range(40) for k in ("a", None)]
    df = make("k string, v int, n int", data)
    got = aggregate_with_distinct(df, ["k"], [F.sum("n").alias("s")], "v", "d", nullable_keys=True)
    assert rows(got) == rows(df.groupBy("k").agg(F.sum("n"), F.count_distinct("v")))
    known = df.filter("k IS NOT NULL")
    got = aggregate_with_distinct(known, ["k"], [F.sum("n").alias("s")], "v", "d")
    assert rows(got) == rows(known.groupBy("k").agg(F.sum("n"), F.count_distinct("v")))


# --- neighbours in groups of any size -------------------------------------------


def brute_neighbours(data, step):
    """(key, order) -> neighbour, by sorting whole groups; NULL sorts last."""
    out = []
    for key in {k for k, _ in data}:
        values = sorted((v for k, v in data if k == key), key=lambda v: (v is None, v))
        for i, v in enumerate(values):
            j = i + step
            out.append((key, v, (values[j],) if 0 <= j < len(values) else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("kind", ["int", "string", "long start", "timestamp_ntz", "date"])
def test_neighbours_across_ranges(make, step, kind):
    rng = random.Random(3)
    # one key holds most of the rows, one is NULL, others are small
    data = list({(rng.choice([1, 1, 1, 1, None, 2, 3]), rng.choice([None, *range(300)])) for _ in range(600)})
    df = make("k int, v int", data)
    convert = {
        "int": F.col("v"),
        "string": F.lpad(F.col("v").cast("string"), 5, "0"),
        "long start": F.concat(F.lit("the same long start of every text "), F.lpad(F.col("v").cast("string"), 5, "0")),
        "timestamp_ntz": F.timestamp_add("HOUR", F.col("v"), F.lit("2020-01-01").cast("timestamp_ntz")),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v")),
    }[kind]
    typed = df.select("k", convert.alias("o"), "v")
    limits = (10_000, 60, 7) if kind in ("int", "long start") else (60,)
    for keys in (["k"], []):
        source = typed if keys else typed.dropDuplicates(["v"]).withColumn("k", F.lit(0))
        wanted = brute_neighbours([(r.k, r.v) for r in source.collect()], step)
        for limit in limits:
            got = with_neighbour(source, keys, ["o"], F.struct("v"), "n", step, rows_per_task=limit)
            found = sorted(((r.k, r.v, tuple(r.n) if r.n else None) for r in got.collect()), key=str)
            assert found == wanted, (keys, limit)


def test_ranks_across_ranges(make):
    rng = random.Random(9)
    data = [(rng.choice([1, 1, 1, None, 2]), rng.choice([None, *range(40)]), i) for i in range(400)]
    df = make("k int, v int, i int", data)
    for keys in (["k"], []):
        wanted = rows(with_rank(df, keys, "v", "r", largest_group=400))
        for limit in (10_000, 60, 7):
            got = with_rank(df, keys, "v", "r", rows_per_task=limit)
            assert got.columns == ["k", "v", "i", "r"] and rows(got) == wanted, (keys, limit)


def test_no_range_is_too_large_unless_its_rows_are_equal(make):
    # values beside a very common one, which sampled cut points miss
    data = [(1, 50)] * 3000 + [(1, v) for v in (*range(10), *range(60, 90), None)] + [(2, 7)]
    df = make("k int, v int", data)
    ranged = in_ranges(df, ["k"], ["v"], 20, len(data))
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("n"), F.count_distinct("k", "v").alias("d"), F.min("v").alias("v")).collect()
    assert sum(r.n for r in sizes) == len(data)
    assert [(r.n, r.d, r.v) for r in sizes if r.n > 20] == [(3000, 1, 50)]
    order = [(r.k, r.v) for r in ranged.orderBy("__range", "k", F.col("v").asc_nulls_last()).collect()]
    assert order == sorted(data, key=lambda x: (x[0], x[1] is None, x[1]))


def test_more_than_a_thousand_ranges(spark):
    df = spark.range(1200).withColumn("id", F.col("id") * 3)
    got = in_ranges(df, [], ["id"], 1, 1200).groupBy("__range").count().agg(F.count("*"), F.max("count")).first()
    assert tuple(got) == (1200, 1)


def test_tests_on_order_do_not_depend_on_the_split(make):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2]), rng.randrange(80), rng.randrange(1, 9)) for _ in range(500)]
    df = make("k int, v int, w int", data).withColumn("hi", F.col("v") + F.col("w"))
    for by in ([], ["k"]):
        whole = rows(sequential_values(df, "v", group_by=by))
        assert whole and rows(sequential_values(df, "v", group_by=by, rows_per_task=9)) == whole
    for key in (None, "k"):
        whole = rows(mutually_exclusive_ranges(df, "v", "hi", key))
        assert whole and rows(mutually_exclusive_ranges(df, "v", "hi", key, rows_per_task=9)) == whole


def test_repeat_rows(make):
    df = make("x string, n bigint", [("a", 1), ("b", 25), ("c", 0), ("d", 10)])
    got = repeat_rows(df, "n", per_task=10)
    assert got.columns == ["x"]
    assert rows(got.groupBy("x").count()) == [("a", 1), ("b", 25), ("d", 10)]


def test_value_list_never_cuts(spark):
    df = spark.range(150).select(F.col("id").cast("string").alias("v"))
    assert len(S.value_list(df, "v")) == 150
    with pytest.raises(ValueError):
        S.value_list(df, "v", 100)
