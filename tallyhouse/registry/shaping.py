"""SG: table-shaping operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.keys import NULL_FIELD, surrogate_key
from tallyhouse.operators import shaping as S
from tallyhouse.operators.series import date_spine, generate_series
from tallyhouse.registry import query
from tallyhouse.registry.common import comparable
from tallyhouse.sources.tables import table


@query(
    "sg1_generate_series",
    """SELECT generated_number FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) + 1 FROM orders))) AS generated_number)
       WHERE generated_number NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order numbers without a line: the series against the keys in use."""
    upper = table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("m")).first()["m"]
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return generate_series(spark, upper).join(keys, F.col("generated_number") == F.col("l_orderkey"), "left_anti")


@query(
    "sg2_date_spine",
    """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
            s AS (SELECT CAST(unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
       SELECT CAST(d AS VARCHAR) AS date_day, count(o_orderkey) AS orders
       FROM s LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""",
)
def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day without gaps, the last day excluded."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    ends = orders.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).first()
    per_day = orders.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    days = date_spine(spark, "day", ends["lo"], ends["hi"])
    joined = days.join(per_day, F.col("date_day") == F.col("d"), "left")
    return comparable(joined.select("date_day", F.coalesce("n", F.lit(0)).alias("orders")))


@query(
    "sg2_month_spine",
    """WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
       SELECT CAST(CAST(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi) - INTERVAL 1 MONTH,
                                               INTERVAL 1 MONTH)) AS DATE) AS VARCHAR) AS date_month FROM b""",
)
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.trunc("o_orderdate", "month")
    ends = table(spark, sf_dir, "orders").agg(F.min(month).alias("lo"), F.max(month).alias("hi")).first()
    return comparable(date_spine(spark, "month", ends["lo"], ends["hi"]))


_ROW = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    "sg3_deduplicate",
    f"""SELECT {', '.join(_ROW)} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_quantity) = 1""",
)
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*_ROW)
    dearest = [F.col("l_extendedprice").desc_nulls_first(), "l_partkey", "l_suppkey", "l_quantity"]
    return S.deduplicate(lines, ["l_orderkey", "l_linenumber"], dearest)


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "sg4_pivot",
    "SELECT o_orderstatus, "
    + ", ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS \"n_{p}\", "
        f"count(DISTINCT CASE WHEN o_orderpriority = '{p}' THEN o_custkey END) AS \"{S.slugify('customers ' + p)}\""
        for p in _PRIORITIES
    )
    + " FROM orders GROUP BY o_orderstatus",
)
def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    values = S.value_list(orders, "o_orderpriority")
    counts = orders.groupBy("o_orderstatus").agg(*S.pivot("o_orderpriority", values, prefix="n_"))
    # distinct customers: each once per status and priority, so that no row multiplies
    buyers = orders.select("o_orderstatus", "o_orderpriority", "o_custkey").distinct().groupBy("o_orderstatus")
    people = buyers.agg(
        *S.pivot(
            "o_orderpriority", values, "count", prefix="customers ", slugs=True,
            then_value=F.col("o_custkey"), else_value=None,
        )
    )
    return counts.join(people, "o_orderstatus")


@query(
    "sg5_unpivot",
    " UNION ALL ".join(
        f"SELECT c_custkey, '{name}' AS prop, {value} AS val FROM customer"
        for name, value in {
            "c_nationkey": "CAST(c_nationkey AS VARCHAR)",
            "c_acctbal": "CAST(c_acctbal AS VARCHAR)",
            "segment": "nullif(c_mktsegment, 'BUILDING')",
            "in_credit": "CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END",
        }.items()
    ),
)
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        (F.col("c_acctbal") > 0).alias("in_credit"),
    )
    return S.unpivot(customer, "string", exclude=["c_custkey"], remove=["C_NAME"], field_name="prop", value_name="val")


_PARTIES = """SELECT '{0}' AS source_relation, c_custkey AS party_key, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance,
              c_mktsegment AS segment, NULL AS nation FROM customer
       UNION ALL SELECT '{1}', s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier"""


def _parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS party_key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment", "1 AS noise"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS party_key", "s_name AS name", "s_acctbal AS balance", "s_nationkey AS nation"
    )
    return customer, supplier


@query("sg6_union_relations", _PARTIES.format("customer", "supplier"))
def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _parties(spark, sf_dir)
    return S.union_relations({"customer": customer, "supplier": supplier}, exclude=["NOISE"])


@query("sg7_union_by_pattern", _PARTIES.format("party_customer", "party_supplier"))
def union_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = _parties(spark, sf_dir)
    for name, df in {"party_customer": customer, "party_supplier": supplier, "party_old": supplier}.items():
        df.createOrReplaceTempView(name)
    return S.union_by_prefix(
        spark, "default", "PARTY_", "%_OLD", include=["party_key", "name", "balance", "segment", "nation"]
    )


@query(
    "sg8_star",
    "SELECT c_custkey AS in_c_custkey_raw, c_acctbal AS in_c_acctbal_raw, c_mktsegment AS in_c_mktsegment_raw FROM customer",
)
def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(*S.star(customer, ["C_NAME", "c_nationkey"], prefix="in_", suffix="_raw"))


@query(
    "sg9_group_by",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2""",
)
def group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    value = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value")
    return comparable(S.group_by_first(orders, 2).agg(F.count(F.lit(1)).alias("orders"), value))


_BLANKED = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END"


@query(
    "sg10_nullcheck_table",
    f"SELECT o_orderkey, nullif({_BLANKED}, '') AS priority, nullif(o_orderstatus, '') AS o_orderstatus FROM orders",
)
def nullcheck_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.nullcheck_table(
        table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_BLANKED).alias("priority"), "o_orderstatus")
    )


@query(
    "sg11_column_values",
    """SELECT o_custkey AS value, count(*) AS n FROM orders WHERE o_orderstatus <> 'F'
       GROUP BY o_custkey ORDER BY n DESC, value LIMIT 20""",
)
def column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.column_values(table(spark, sf_dir, "orders"), "o_custkey", max_records=20, where="o_orderstatus <> 'F'")


@query(
    "sg12_surrogate_key",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey,
        md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
            || coalesce(nullif(l_returnflag, 'N'), '{NULL_FIELD}')) AS key,
        md5(coalesce(nullif(l_returnflag, 'N'), '') || '-' || CAST(l_suppkey AS VARCHAR)) AS older_key FROM lineitem""",
)
def surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        surrogate_key(["l_orderkey", "l_linenumber", flag]).alias("key"),
        surrogate_key([flag, "l_suppkey"], nulls_as_empty=True).alias("older_key"),
    )


@query(
    "sg13_single_value",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM orders WHERE o_orderstatus = 'F')""",
)
def single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    limit = S.single_value(orders.filter("o_orderstatus = 'F'").agg(F.max("o_totalprice") * 0.9), default=0.0)
    return orders.filter(F.col("o_totalprice") > limit).select("o_orderkey", "o_totalprice")
