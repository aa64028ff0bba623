"""SC: scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.arithmetic import safe_add, safe_divide, safe_subtract, width_bucket
from tallyhouse.functions.geo import haversine_distance
from tallyhouse.functions.web import url_host, url_parameter, url_path
from tallyhouse.registry import query
from tallyhouse.sources.tables import table

_A, _B, _C = "nullif(l_linenumber, 3)", "nullif(CAST(l_quantity AS INTEGER), 10)", "nullif(CAST(l_suppkey % 5 AS INTEGER), 0)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("a"),
        F.nullif(F.col("l_quantity").cast("int"), F.lit(10)).alias("b"),
        F.nullif((F.col("l_suppkey") % 5).cast("int"), F.lit(0)).alias("c"),
    )


@query(
    "sc1_safe_add",
    f"SELECT l_orderkey, l_linenumber, coalesce({_A}, 0) + coalesce({_B}, 0) + coalesce({_C}, 0) AS total FROM lineitem",
)
def add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", safe_add(["a", "b", "c"]).alias("total"))


@query(
    "sc2_safe_subtract",
    f"SELECT l_orderkey, l_linenumber, coalesce({_A}, 0) - coalesce({_B}, 0) - coalesce({_C}, 0) AS rest FROM lineitem",
)
def subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", safe_subtract(["a", "b", "c"]).alias("rest"))


@query(
    "sc3_safe_divide",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS quotient,
       nullif(l_quantity, 10) / nullif(l_suppkey % 5, 0) AS per_c FROM lineitem""",
)
def divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_divide("l_extendedprice", "l_discount").alias("quotient"),
        safe_divide(F.nullif(F.col("l_quantity"), F.lit(10.0)), F.col("l_suppkey") % 5).alias("per_c"),
    )


@query(
    "sc4_width_bucket",
    """SELECT p_partkey, CAST(CASE WHEN p_retailprice < 950 THEN 0 WHEN p_retailprice >= 1050 THEN 9
       ELSE floor((p_retailprice - 950) * 8 / 100) + 1 END AS BIGINT) AS bucket FROM part""",
)
def bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", width_bucket("p_retailprice", 950, 1050, 8).alias("bucket"))


def _haversine_sql(scale: str) -> str:
    chord = (
        "pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
        "* pow(sin(radians((lon2 - lon1) / 2)), 2)"
    )
    return f"round(2 * 3961 * asin(sqrt(least({chord}, 1.0))) * {scale}, 6)"


_POINTS = """(SELECT o_orderkey, CAST(o_orderkey % 180 - 90 AS DOUBLE) AS lat1, CAST(o_custkey % 360 - 180 AS DOUBLE) AS lon1,
              CAST(o_custkey % 180 - 90 AS DOUBLE) AS lat2, CAST(o_orderkey % 360 - 180 AS DOUBLE) AS lon2 FROM orders)"""


@query(
    "sc5_haversine_distance",
    f"SELECT o_orderkey, {_haversine_sql('1')} AS miles, {_haversine_sql('1.60934')} AS km FROM {_POINTS}",
)
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 180 - 90).cast("double").alias("lat1"),
        (F.col("o_custkey") % 360 - 180).cast("double").alias("lon1"),
        (F.col("o_custkey") % 180 - 90).cast("double").alias("lat2"),
        (F.col("o_orderkey") % 360 - 180).cast("double").alias("lon2"),
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return points.select(
        "o_orderkey",
        F.round(haversine_distance(*ends), 6).alias("miles"),
        F.round(haversine_distance(*ends, unit="km"), 6).alias("km"),
    )


_HOST = (
    "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"
)
_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("sc6_url_host", f"SELECT page_id, url, {_HOST} AS host FROM pages")
def host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", url_host("url").alias("host"))


@query(
    "sc7_url_path",
    f"""SELECT page_id, url, split_part(substr(bare, cut + 1), '?', 1) AS path
        FROM (SELECT page_id, url, {_BARE} AS bare,
                     greatest(coalesce(nullif(strpos({_BARE}, '/'), 0), strpos({_BARE}, '?') - 1), 0) AS cut FROM pages)""",
)
def path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", url_path("url").alias("path"))


@query(
    "sc8_url_parameter",
    "SELECT page_id, "
    + ", ".join(f"nullif(split_part(split_part(url, '{p}=', 2), '&', 1), '') AS {p}" for p in ("page", "ref", "q"))
    + " FROM pages",
)
def parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", *[url_parameter("url", p).alias(p) for p in ("page", "ref", "q")]
    )
