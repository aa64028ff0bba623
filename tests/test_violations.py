"""Generic tests: cases that pass, cases that fail, and where NULL stands."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import violations as V
from tallyhouse.quality.checks import InRange, NotNull, References, Unique, run_suite, suite_totals
from tallyhouse.quality.grading import Test, grade


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def make(spark):
    return lambda schema, data: spark.createDataFrame(data, schema)


def test_equal_rowcount(make):
    a = make("g int", [(1,), (1,), (2,)])
    assert rows(V.equal_rowcount(a, a)) == [(3, 3, 0)]
    assert rows(V.equal_rowcount(a, a, ["g"])) == [(1, 1, 2, 2, 0), (2, 2, 1, 1, 0)]
    b = make("g int", [(1,), (3,)])
    assert rows(V.equal_rowcount(a, b)) == [(3, 2, 1)]
    # a group on one side only has no difference, so it does not fail
    assert rows(V.equal_rowcount(a, b, ["g"])) == [(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 1, None)]


def test_groups_of_null_do_not_meet(make):
    a = make("g int", [(None,), (None,)])
    assert rows(V.equal_rowcount(a, a, ["g"])) == [(None, None, 2, None, None), (None, None, None, 2, None)]


def test_fewer_rows_than(make):
    a, b = make("g int", [(1,), (1,), (2,)]), make("g int", [(1,), (2,), (2,), (2,)])
    assert rows(V.fewer_rows_than(a, b)) == [(3, 4, 0)]
    assert rows(V.fewer_rows_than(b, a)) == [(4, 3, 1)]
    assert rows(V.fewer_rows_than(a, a)) == [(3, 3, 1)]
    assert rows(V.fewer_rows_than(a, b, ["g"])) == [(1, 1, 2, 1, 1), (2, 2, 1, 3, 0)]


def test_equality_compares_sets(make):
    a = make("x int, y string", [(1, "a"), (1, "a"), (2, None), (3, "c")])
    b = make("x int, y string", [(1, "a"), (2, None), (4, "d"), (5, "e")])
    found = V.equality(a, b)
    assert rows(found) == [("a_minus_b", 3, "c"), ("b_minus_a", 4, "d"), ("b_minus_a", 5, "e")]
    assert found.agg(V.equality_failures()).first()[0] == 3 + 1
    assert rows(V.equality(a, b, ["y"])) == [("a_minus_b", "c"), ("b_minus_a", "d"), ("b_minus_a", "e")]
    assert rows(V.equality(a, a.distinct())) == []


def test_equality_can_count_copies(make):
    a = make("x int", [(1,)] * 5 + [(2,)])
    b = make("x int", [(1,)] * 2 + [(2,)])
    assert rows(V.equality(a, b, copies=True)) == rows(a.exceptAll(b).select(F.lit("a_minus_b"), "x"))


def test_cardinality_equality(make):
    a, b = make("v int", [(1,), (1,), (2,), (None,)]), make("w int", [(1,), (2,), (3,), (None,)])
    assert rows(V.cardinality_equality(a, "v", b, "w")) == [(1, 1), (1, 2), (3, 1)]
    assert rows(V.cardinality_equality(a, "v", a, "v")) == []


def test_rules_about_single_rows(make):
    df = make("a double, b double", [(0.0, 1.0), (1.0, 0.0), (0.5, 0.4), (None, 1.0)])
    assert rows(V.expression_is_true(df, "a + b = 1")) == [(0.5, 0.4)]
    assert rows(V.expression_is_true(df, "< 1", "a")) == [(1.0, 0.0)]
    assert rows(V.accepted_range(df, "a", 0, 0.5)) == [(1.0, 0.0)]
    assert rows(V.accepted_range(df, "a", 0, 1, inclusive=False)) == [(0.0, 1.0), (1.0, 0.0)]
    assert rows(V.accepted_range(df, "a")) == []
    assert rows(V.not_null(df, "a")) == [(None, 1.0)]
    assert rows(V.assert_equal(df, "a", "b")) == [(0.0, 1.0), (0.5, 0.4), (1.0, 0.0)]


def test_not_empty_string(make):
    df = make("s string", [("   ",), ("",), (None,), ("x",)])
    assert rows(V.not_empty_string(df, "s")) == [("",), ("",)]
    assert rows(V.not_empty_string(df, "s", trim_whitespace=False)) == [("",)]


def test_values(make):
    df = make("v string", [("a",), ("b",), ("b",), (None,)])
    assert rows(V.accepted_values(df, "v", ["a"])) == [("b", 2)]
    assert rows(V.accepted_values(df, "v", ["a", "b"])) == []
    assert rows(V.not_accepted_values(df, "v", ["b", "z"])) == [("b",)]
    assert rows(V.unique(df, "v")) == [("b", 2)]
    pairs = make("x int, y int", [(1, None), (1, None), (1, 2)])
    assert rows(V.unique_combination_of_columns(pairs, ["x", "y"])) == [(1, None)]


def test_uniqueness_test_ignores_null_but_the_check_counts_it(make):
    df = make("v int", [(1,), (None,), (None,)])
    assert rows(V.unique(df, "v")) == []
    assert run_suite(df, [Unique("v")], "l", "t").first().duplicate_rows == 2


def test_columns_match_set(make):
    df = make("Id int, city string", [])
    assert rows(V.columns_match_set(df, ["ID", "CITY"])) == []
    assert rows(V.columns_match_set(df, ["id", "town"])) == [("CITY", None), (None, "TOWN")]


def test_at_least_one_looks_at_every_group(make):
    df = make("g int, v string", [(1, "a"), (1, None), (2, None), (2, None)])
    assert rows(V.at_least_one(df, "v", ["g"])) == [(2, 0)]
    assert rows(V.at_least_one(df, "v")) == []
    assert rows(V.at_least_one(df.filter("g = 2"), "v")) == [(0,)]
    assert rows(V.at_least_one(df.filter("false"), "v")) == [(0,)]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_not_constant(make, kind):
    df = make("g int, v int", [(1, 1), (1, None), (2, 1), (2, 2), (3, None)]).withColumn("v", F.col("v").cast(kind))
    assert rows(V.not_constant(df, "v", ["g"])) == [(1, 1)]
    assert rows(V.not_constant(df, "v")) == []
    assert rows(V.not_constant(df.filter("g = 1"), "v")) == [(1,)]


def test_not_null_proportion(make):
    df = make("g int, v int", [(1, 1), (1, None), (2, 1), (2, 1)])
    assert rows(V.not_null_proportion(df, "v", 0.75)) == []
    assert rows(V.not_null_proportion(df, "v", 0.8)) == [(0.75,)]
    assert rows(V.not_null_proportion(df, "v", 0.6, 0.9, ["g"])) == [(1, 0.5), (2, 1.0)]
    assert rows(V.not_null_proportion(df.filter("g = 1"), "v", 0.5, 0.5)) == []


def test_recency(spark, make):
    now = datetime(2023, 7, 21, 6)
    df = spark.sql("SELECT TIMESTAMP_NTZ '2023-07-20 07:00:00' AS t UNION ALL SELECT TIMESTAMP_NTZ '2023-07-01 00:00:00'")
    assert rows(V.recency(df, "t", "day", 1, now)) == []
    early = spark.sql("SELECT TIMESTAMP_NTZ '2023-07-20 00:00:00' AS t")
    assert len(rows(V.recency(early, "t", "day", 1, now))) == 1
    assert rows(V.recency(early, "t", "day", 1, now, ignore_time=True)) == []
    assert rows(V.recency(df.filter("false"), "t", "day", 1, now)) == []
    grouped = df.withColumn("g", F.dayofmonth("t"))
    assert [r.g for r in V.recency(grouped, "t", "day", 1, now, group_by=["g"]).collect()] == [1]


def test_relationships(make):
    child, parent = make("id int, k string", [(1, "x"), (2, "x"), (4, "y"), (4, "y"), (None, "x")]), make("id int", [(1,), (2,), (3,), (1,)])
    assert rows(V.relationships(child, "id", parent, "id")) == [(4,), (4,)]
    assert rows(V.relationships_where(child, "id", parent, "id", from_condition="id <> 4")) == []
    assert rows(V.relationships_where(child, "id", parent, "id", "k = 'x'", "id > 1")) == [(1, None)]
    assert V.orphan_count(child, "id", parent, "id").first()[0] == 2


def test_a_hot_child_key_is_one_row_of_the_join(spark, make):
    child = spark.range(0, 30_000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 7 END AS k")
    parent = make("p bigint", [(i,) for i in range(0, 30_000, 2)])
    found = V.relationships_where(child, "k", parent, "p")
    assert found.groupBy("id").count().orderBy(F.desc("count")).first()[:] == (7, 20_000)
    assert found.count() == 20_000 + 5_000 and found.filter("right_id IS NOT NULL").count() == 0
    assert rows(V.relationships(child, "k", parent, "p").filter("from_field < 5")) == [(3,)]
    # the child is counted before its first exchange
    plan = found._jdf.queryExecution().sparkPlan().toString()
    scan = plan[: plan.index("Range (")].splitlines()
    assert any("HashAggregate" in line for line in scan[-4:])


def test_sequential_values(make):
    even = make("g int, v int", [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)])
    assert rows(V.sequential_values(even, "v", 2)) == []
    assert rows(V.sequential_values(even, "v", 2, group_by=["g"])) == []
    assert rows(V.sequential_values(even, "v", 1, group_by=["g"])) == [(1, 4, 2), (1, 6, 4), (2, 10, 8)]
    twice = make("v int", [(1,), (1,), (1,), (2,), (None,)])
    assert rows(V.sequential_values(twice, "v")) == [(1, 1), (1, 1)]


def test_sequential_hours(spark):
    df = spark.sql("SELECT explode(sequence(0, 3)) AS i").selectExpr(
        "timestampadd(HOUR, i, TIMESTAMP_NTZ '2021-01-01 00:00:00') AS t"
    )
    assert rows(V.sequential_values(df, "t", 1, "hour")) == []
    gap = df.filter("hour(t) <> 2")
    assert [r.t.hour for r in V.sequential_values(gap, "t", 1, "hour").collect()] == [3]


def test_mutually_exclusive_ranges(make):
    touching = make("lo int, hi int", [(0, 1), (1, 2), (2, 4)])
    assert rows(V.mutually_exclusive_ranges(touching, "lo", "hi", gaps="not_allowed")) == []
    assert len(rows(V.mutually_exclusive_ranges(touching, "lo", "hi", gaps="required"))) == 2
    overlapping = make("lo int, hi int", [(0, 2), (1, 3), (3, 3)])
    found = V.mutually_exclusive_ranges(overlapping, "lo", "hi")
    assert [tuple(r) for r in found.orderBy("lower_bound").collect()] == [(0, 2, 1, None, "overlap"), (3, 3, None, "empty", None)]
    assert [r.lower_bound for r in V.mutually_exclusive_ranges(overlapping, "lo", "hi", zero_length_allowed=True).collect()] == [0]
    twice = make("lo int, hi int", [(5, 4), (7, 8), (7, 8), (None, 3), (9, None)])
    assert Counter(tuple(r) for r in V.mutually_exclusive_ranges(twice, "lo", "hi").collect()) == Counter(
        [(5, 4, 7, "reversed", None), (7, 8, 7, None, "overlap"), (9, None, None, "open", "unknown"), (None, 3, None, "open", None)]
    )
    with pytest.raises(ValueError):
        V.mutually_exclusive_ranges(touching, "lo", "hi", gaps="some")


def test_open_ranges_and_partitions(make):
    d = date.fromisoformat
    df = make(
        "id int, lo date, hi date",
        [(1, d("2019-01-01"), d("2019-02-01")), (1, d("2019-03-03"), d("2019-04-01")), (2, d("2019-05-06"), d("2019-07-02")), (2, d("2019-07-03"), None)],
    )
    closed = "coalesce(hi, DATE '2099-01-01')"
    assert rows(V.mutually_exclusive_ranges(df, "lo", closed, "id", "required")) == []
    # an open end counts as a violation of its own
    assert [r.lower_bound for r in V.mutually_exclusive_ranges(df, "lo", "hi", "id").collect()] == [d("2019-07-03")]


def test_grading(spark):
    df = spark.sql("SELECT 5 AS n")

    def status(**kw):
        return df.select(grade(F.col("n"), **kw)).first()[0]

    assert status() == "error"
    assert status(severity="warn") == "warn"
    assert status(error_if=">10") == "warn"
    assert status(error_if=">10", warn_if="> 5") == "pass"
    assert status(error_if="<1") == "warn"
    assert status(severity="warn", error_if=">=1", warn_if="=0") == "pass"
    with pytest.raises(ValueError):
        Test("t", lambda d: d, severity="fatal")


def test_where_and_fail_calc(make):
    df = make("g int, v int", [(1, 1), (1, 2), (2, 9)])
    test = Test("t", lambda d: V.accepted_range(d, "v", 0, 5), where="g = 1")
    assert tuple(test.failures(df).first()) == ("t", 0, "pass")
    counted = Test("t", lambda d: V.equal_rowcount(d, df.limit(1)), fail_calc=V.rowcount_failures)
    assert tuple(counted.failures(df).first()) == ("t", 2, "error")


def test_suite_on_an_empty_table_is_an_error(make):
    df = make("v int", [])
    result = run_suite(df, [NotNull("v"), InRange("v", 0)], "l", "t")
    got = {r.check_type: (r.null_percentage, r.status) for r in result.collect()}
    assert got == {"not_null": (None, "ERROR"), "range": (None, "PASS")}
    assert suite_totals(result).first().failed_checks == 1
    keyed = run_suite(df, [NotNull("v"), Unique("v")], "l", "t")
    assert {r.check_type: r.status for r in keyed.collect()} == {"not_null": "ERROR", "unique": "PASS"}


def test_suite_results(make):
    df = make("v int, w int", [(1, 5), (1, None), (None, 50)])
    parent = make("k int", [(5,)])
    checks = [NotNull("v"), Unique("v"), NotNull("w"), InRange("w", 0, 10), InRange("w"), References("w", parent, "k")]
    got = {(r.check_type, r.column_name, r.max_value): r for r in run_suite(df, checks, "l", "t").collect()}
    assert got["not_null", "v", None].null_percentage == 33.33 and got["not_null", "v", None].null_rows == 1
    assert got["unique", "v", None].unique_values == 1 and got["unique", "v", None].duplicate_rows == 2
    assert got["not_null", "w", None].non_null_rows == 2
    assert got["range", "w", 10.0].out_of_range_rows == 1
    assert got["range", "w", None].status == "PASS"
    assert got["referential_integrity", "w", None].orphaned_rows == 1
    with pytest.raises(TypeError):
        run_suite(df, ["v"], "l", "t")
