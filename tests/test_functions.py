from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as C
from tallyhouse.functions.arithmetic import mean, ratio, safe_add, safe_divide, safe_subtract, width_bucket
from tallyhouse.functions.geo import haversine_distance
from tallyhouse.functions.keys import surrogate_key
from tallyhouse.functions.web import url_host, url_parameter, url_path


def one(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def texts(spark, values, column):
    return one(spark, "x string", [(v,) for v in values], column)


def x():
    return F.col("x")


def test_missing_is_null_or_blank(spark):
    assert texts(spark, [None, "", "   ", "\t", "a"], C.is_missing(x())) == [True, True, True, False, False]


def test_ids(spark):
    values = ["1001", "T1010", "X12", "TT1", "T", " 12 ", "12\n", "", None, "t5"]
    assert texts(spark, values, C.clean_id(x(), "T")) == [1001, 1010] + [None] * 8
    assert texts(spark, values, C.has_prefix(x(), "T")) == [False, True] + [False] * 8


def test_an_id_beyond_64_bits_is_null_instead_of_a_failed_job(spark):
    assert texts(spark, ["99999999999", "9" * 30], C.clean_id(x(), "T")) == [99999999999, None]


def test_dates(spark):
    values = ["2023-07-11", "18-07-2023", "2023-02-30", "2023-13-01", "30-02-2023", "2023/07/11", "2023-7-1", "", None, "2023-07-11\n"]
    got = [str(d) if d else None for d in texts(spark, values, C.parse_date(x()))]
    assert got == ["2023-07-11", "2023-07-18"] + [None] * 8


def test_amounts(spark):
    values = ["76.27", "12.", "1.005", "-5", " 12 ", "1e3", "Two Hundred", "", None, "7\n", "999999999"]
    expected = [Decimal("76.27"), Decimal("12.00"), Decimal("1.01")] + [None] * 8
    assert texts(spark, values, C.parse_amount(x())) == expected


def test_whole_numbers_truncate(spark):
    values = ["5.0", "5.9", "12.", "-5", "5.0.0", "abc", "", None]
    assert texts(spark, values, C.whole_number(x())) == [5, 5, 12] + [None] * 5
    assert texts(spark, values, C.is_invalid_number(x())) == [False] * 3 + [True] * 5


def test_letters(spark):
    assert texts(spark, ["Fifteen", "1e3", "12", "é", None], C.has_letters(x())) == [True, True, False, False, False]


def test_names_can_be_padded(spark):
    df = spark.sql("SELECT DATE '2023-07-10' AS d")
    row = df.select(C.day_name(F.col("d")), C.day_name(F.col("d"), True), C.month_name(F.col("d"), True)).first()
    assert tuple(row) == ("Monday", "Monday   ", "July     ")


INTS = "a int, b int, c int"


def test_safe_arithmetic(spark):
    rows = [(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)]
    assert one(spark, INTS, rows, safe_add(["a", "b", "c"])) == [6, 4, 2, 0]
    rows = [(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)]
    assert one(spark, INTS, rows, safe_subtract(["a", "b", "c"])) == [0, 1, -2, 0]
    rows = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    assert one(spark, "n int, d int", rows, safe_divide("n", "d")) == [None, 2, None, None, None, None, None, 0]
    with pytest.raises(TypeError):
        safe_add("a")


def test_ratio_rounds_half_up(spark):
    rows = [(Decimal("0.05"), 10), (Decimal("201.00"), 200), (Decimal("1.00"), 3), (Decimal("1.00"), 0)]
    got = one(spark, "n decimal(10,2), d bigint", rows, ratio(F.col("n"), F.col("d")))
    assert got == [Decimal("0.01"), Decimal("1.01"), Decimal("0.33"), None]


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (3,), (4,)], "x int")
    assert df.agg(mean("x")).first()[0] == 3.5
    assert df.filter("x > 9").agg(mean("x")).first()[0] is None


def test_width_bucket(spark):
    """Follows the documented bins: 0 below the range, n + 1 at its end."""
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 600000.0, 610000.0, -1e9]
    got = one(spark, "x double", [(a,) for a in amounts], width_bucket("x", 200000, 600000, 4))
    assert got == [0, 1, 2, 2, 3, 3, 4, 5, 5, 0]


def test_haversine(spark):
    rows = [(48.864716, 2.349014, 52.379189, 4.899431)]
    schema = "a double, b double, c double, d double"
    assert round(one(spark, schema, rows, haversine_distance("a", "b", "c", "d", "km"))[0]) == 430
    assert round(one(spark, schema, rows, haversine_distance("a", "b", "c", "d"))[0]) == 267
    antipodes = one(spark, schema, [(0.0, 0.0, 0.0, 180.0)], haversine_distance("a", "b", "c", "d"))[0]
    assert round(antipodes) == round(3961 * 3.141592653589793)
    with pytest.raises(ValueError):
        haversine_distance("a", "b", "c", "d", "nm")


def test_url_parts(spark):
    hosts = {
        "www.google.co.uk?utm_source=google&utm_medium=cpc": "www.google.co.uk",
        "http://witanddelight.com/2018/01/tips/": "witanddelight.com",
        "android-app://m.facebook.com/": "m.facebook.com",
        "https://m.facebook.com/": "m.facebook.com",
        None: None,
    }
    assert texts(spark, list(hosts), url_host("x")) == list(hosts.values())
    paths = {
        "www.google.co.uk?utm_source=google": "",
        "http://witanddelight.com/2018/01/tips/?utm_source=google": "2018/01/tips/",
        "https://www.nytimes.com/2018/01/01/blog": "2018/01/01/blog",
        "https://m.example.net/en/25#top": "en/25#top",
        "plain": "plain",
        "a.com?next=/b/c": "b/c",
        None: None,
    }
    assert texts(spark, list(paths), url_path("x")) == list(paths.values())
    urls = ["http://x.com/m?utm_medium=organic", "http://x.com/m?utm_medium=organic&utm_source=github", "x?utm_source=", None]
    assert texts(spark, urls, url_parameter("x", "utm_source")) == [None, "github", None, None]
    assert texts(spark, ["x?my_source=1"], url_parameter("x", "source")) == ["1"]


def test_surrogate_keys(spark):
    """The expected digests are fixed values."""
    rows = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    expected = [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]
    assert one(spark, "a string, b string, c string", rows, surrogate_key(["a", "b", "c"])) == expected
    rows = [("a-b", "c"), ("a", "b-c")]
    assert len(set(one(spark, "a string, b string", rows, surrogate_key(["a", "b"])))) == 1
