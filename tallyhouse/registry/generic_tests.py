"""GT: generic tests as queries of the rows that break a rule."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import violations as V
from tallyhouse.plans.warehouse import LAYERS
from tallyhouse.quality.declared import Rule, declared_rules, run_declared
from tallyhouse.quality.grading import Test
from tallyhouse.registry import query
from tallyhouse.registry.common import CTX, comparable, raw, warehouse
from tallyhouse.registry.sqltext import sql
from tallyhouse.sources.raw import union_all
from tallyhouse.sources.tables import table


@query(
    "gt1_equal_rowcount",
    """SELECT a.k AS okey_a, b.k AS okey_b, count_a, count_b, abs(count_a - count_b) AS diff_count
       FROM (SELECT o_orderkey AS k, count(*) AS count_a FROM orders GROUP BY 1) a
       FULL JOIN (SELECT l_orderkey AS k, count(*) AS count_b FROM lineitem GROUP BY 1) b ON a.k = b.k""",
)
def equal_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "okey")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "okey")
    return V.equal_rowcount(orders, lines, ["okey"])


@query(
    "gt2_fewer_rows_than",
    """SELECT a.k AS ckey_a, b.k AS ckey_b, count_our_model, count_comparison_model,
              CASE WHEN count_our_model > count_comparison_model THEN count_our_model - count_comparison_model
                   WHEN count_our_model = count_comparison_model THEN 1 ELSE 0 END AS row_count_delta
       FROM (SELECT o_custkey AS k, count(*) AS count_our_model FROM orders GROUP BY 1) a
       FULL JOIN (SELECT c_custkey AS k, 10 * count(*) AS count_comparison_model
                  FROM customer GROUP BY 1) b ON a.k = b.k""",
)
def fewer_rows_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "ckey")
    ten = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i")
    allowance = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ckey"), ten)
    return V.fewer_rows_than(orders, allowance, ["ckey"])


_CHANGED = "CASE WHEN c_nationkey = 3 THEN lower(c_mktsegment) ELSE c_mktsegment END"


@query(
    "gt3_equality",
    f"""WITH a AS (SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 0),
             b AS (SELECT c_nationkey, {_CHANGED} AS c_mktsegment FROM customer)
        SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    changed = customer.withColumn("c_mktsegment", F.expr(_CHANGED))
    return V.equality(customer.filter("c_acctbal > 0"), changed, ["c_nationkey", "c_mktsegment"])


@query("gt4_expression_is_true", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice >= 100000)")
def expression_is_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.expression_is_true(table(spark, sf_dir, "orders"), ">= 100000", "o_totalprice").select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "gt5_recency",
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS most_recent, '2024-01-29 06:00:00' AS threshold
       FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-29 06:00:00'""",
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = datetime(2024, 1, 31, 6)
    return comparable(V.recency(table(spark, sf_dir, "events"), "ts", "hour", 48, now, group_by=["user_id"]))


@query(
    "gt6_at_least_one",
    """SELECT o_orderkey, count(l_linenumber) AS n_values FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY o_orderkey HAVING count(l_linenumber) = 0""",
)
def at_least_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line. Both tables meet in the grouping, where a hot order combines map-side."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.lit(None).cast("int").alias("l_linenumber"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return V.at_least_one(orders.union(lines), "l_linenumber", ["o_orderkey"])


@query(
    "gt7_not_constant",
    """SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem
       GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1""",
)
def not_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.not_constant(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_orderkey"])


_LABEL = "CASE event_type WHEN 'view' THEN '   ' WHEN 'error' THEN '' WHEN 'click' THEN NULL ELSE event_type END"


@query("gt8_not_empty_string", f"SELECT trim({_LABEL}) AS label FROM events WHERE trim({_LABEL}) = ''")
def not_empty_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.not_empty_string(table(spark, sf_dir, "events").select(F.expr(_LABEL).alias("label")), "label")


@query(
    "gt9_cardinality_equality",
    """WITH a AS (SELECT o_orderkey AS value, count(*) AS num_rows FROM orders GROUP BY 1),
            b AS (SELECT l_orderkey AS value, count(*) AS num_rows FROM lineitem GROUP BY 1)
       SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def cardinality_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.cardinality_equality(
        table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey"
    )


@query(
    "gt10_not_null_proportion",
    sql(
        """SELECT product_id, CAST(count(customer_id) AS DOUBLE) / count(*) AS not_null_proportion
           FROM raw GROUP BY product_id HAVING CAST(count(customer_id) AS DOUBLE) / count(*) < 0.85""",
        "raw",
    ),
)
def not_null_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.not_null_proportion(raw(spark, sf_dir), "customer_id", 0.85, group_by=["product_id"])


@query(
    "gt11_not_accepted_values",
    """SELECT DISTINCT o_orderpriority AS value_field FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED', '9-NONE')""",
)
def not_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.not_accepted_values(
        table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "4-NOT SPECIFIED", "9-NONE"]
    )


@query(
    "gt12_relationships_where",
    """SELECT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'
       AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""",
)
def relationships_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.relationships_where(
        table(spark, sf_dir, "lineitem"),
        "l_orderkey",
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        "l_returnflag = 'R'",
        "o_orderstatus <> 'F'",
    ).drop("right_id")


@query(
    "gt13_mutually_exclusive_ranges",
    """WITH r AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS lo,
                         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS hi FROM orders),
            w AS (SELECT *, lead(lo) OVER (PARTITION BY k ORDER BY lo, hi) AS nxt FROM r)
       SELECT k AS partition_by_col, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound,
              CAST(nxt AS VARCHAR) AS next_lower_bound, CASE WHEN lo = hi THEN 'empty' END AS shape,
              CASE WHEN hi > nxt THEN 'overlap' END AS meets_next
       FROM w WHERE lo = hi OR hi > nxt""",
)
def mutually_exclusive_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    ranges = table(spark, sf_dir, "orders").select(
        "o_custkey", day.alias("lo"), F.date_add(day, (F.col("o_orderkey") % 60).cast("int")).alias("hi")
    )
    return comparable(V.mutually_exclusive_ranges(ranges, "lo", "hi", "o_custkey"))


@query(
    "gt14_sequential_values",
    """SELECT l_orderkey, l_linenumber, prev AS previous_l_linenumber
       FROM (SELECT l_orderkey, l_linenumber,
                    lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS prev FROM lineitem)
       WHERE NOT (l_linenumber = prev + 1)""",
)
def sequential_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.sequential_values(table(spark, sf_dir, "lineitem"), "l_linenumber", group_by=["l_orderkey"])


@query(
    "gt14_sequential_hours",
    """SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour, strftime(prev, '%Y-%m-%d %H:%M:%S') AS previous_hour
       FROM (SELECT h, lag(h) OVER (ORDER BY h) AS prev FROM (SELECT date_trunc('hour', ts) AS h FROM events))
       WHERE NOT (h = prev + INTERVAL 1 HOUR)""",
)
def sequential_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = table(spark, sf_dir, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return comparable(V.sequential_values(hours, "hour", 1, "hour"))


@query(
    "gt15_unique_combination_of_columns",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unique_combination_of_columns(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "gt16_accepted_range",
    """SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
       WHERE NOT l_discount > 0.01 OR NOT l_discount < 0.09""",
)
def accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return V.accepted_range(lines, "l_discount", 0.01, 0.09, inclusive=False)


@query(
    "gt17_unique",
    """SELECT l_partkey AS unique_field, count(*) AS n_records FROM lineitem WHERE l_partkey IS NOT NULL
       GROUP BY l_partkey HAVING count(*) > 1""",
)
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.unique(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("gt18_not_null", sql("SELECT transaction_id, product_id FROM raw WHERE customer_id IS NULL", "raw"))
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.not_null(raw(spark, sf_dir), "customer_id").select("transaction_id", "product_id")


@query(
    "gt19_accepted_values",
    """SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""",
)
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "gt20_relationships",
    """SELECT c_custkey AS from_field FROM customer WHERE c_custkey IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
)
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.relationships(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "events"), "user_id")


@query(
    "gt21_assert_equal",
    """SELECT l_orderkey, l_linenumber, nullif(l_linenumber, 7) AS actual, CAST(l_suppkey % 7 + 1 AS INTEGER) AS expected
       FROM lineitem WHERE nullif(l_linenumber, 7) <> l_suppkey % 7 + 1""",
)
def assert_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("actual"),
        (F.col("l_suppkey") % 7 + 1).cast("int").alias("expected"),
    )
    return V.assert_equal(pairs, "actual", "expected")


@query(
    "gt23_test_modifiers",
    """WITH t AS (
         SELECT 'where_filter' AS test, count(*) AS failures FROM orders WHERE o_orderstatus = 'O' AND NOT o_totalprice <= 450000
         UNION ALL SELECT 'warn_only', count(*) FROM orders WHERE NOT o_totalprice <= 450000
         UNION ALL SELECT 'threshold', count(*) FROM orders WHERE NOT o_totalprice <= 450000
         UNION ALL SELECT 'expected_to_fail', count(*) FROM orders WHERE o_orderpriority IS NULL
         UNION ALL SELECT 'summed', sum(abs(n - 7)) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey))
       SELECT test, CAST(failures AS BIGINT) AS failures,
              CASE test WHEN 'where_filter' THEN CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END
                        WHEN 'warn_only' THEN CASE WHEN failures <> 0 THEN 'warn' ELSE 'pass' END
                        WHEN 'threshold' THEN CASE WHEN failures > 1000000000 THEN 'error'
                                                   WHEN failures > 10 THEN 'warn' ELSE 'pass' END
                        WHEN 'expected_to_fail' THEN CASE WHEN failures < 1 THEN 'error' ELSE 'warn' END
                        ELSE CASE WHEN failures >= 100 THEN 'error' ELSE 'warn' END END AS status FROM t""",
)
def test_modifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")

    def dear(df: DataFrame) -> DataFrame:
        return V.accepted_range(df, "o_totalprice", high=450000)

    on_orders = [
        Test("where_filter", dear, where="o_orderstatus = 'O'"),
        Test("warn_only", dear, severity="warn"),
        Test("threshold", dear, warn_if=">10", error_if="> 1000000000"),
        Test("expected_to_fail", lambda df: V.not_null(df, "o_orderpriority"), error_if="<1"),
    ]
    summed = Test(
        "summed",
        lambda df: df.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")),
        error_if=">=100",
        fail_calc=lambda: F.sum(F.abs(F.col("n") - 7)),
    )
    return union_all([t.failures(orders) for t in on_orders] + [summed.failures(lines)])


_TABLE_SQL = {
    "customer_transactions": "raw_rows",
    "stg_transactions": "stg_rows",
    "dim_customers": "dim_customers",
    "dim_products": "dim_products",
    "dim_dates": "calendar",
    "fact_transactions": "fact_rows",
    "monthly_customer_summary": "monthly",
    "product_performance": "performance",
}


def _rule_sql(table_name: str, rule: Rule) -> str:
    source = f"(SELECT * FROM {_TABLE_SQL[table_name]} WHERE {rule.where or 'TRUE'})"
    c = rule.column
    if rule.kind == "not_null":
        found = f"SELECT 1 FROM {source} WHERE {c} IS NULL"
    elif rule.kind == "expression_is_true":
        found = f"SELECT 1 FROM {source} WHERE NOT ({rule.expression})"
    elif rule.kind == "accepted_range":
        found = f"SELECT 1 FROM {source} WHERE {c} < {rule.low} OR {c} > {rule.high}"
    elif rule.kind == "accepted_values":
        listed = ", ".join(str(v).upper() if isinstance(v, bool) else f"'{v}'" for v in rule.values)
        found = f"SELECT DISTINCT {c} FROM {source} WHERE {c} NOT IN ({listed})"
    elif rule.kind == "unique":
        found = f"SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    elif rule.kind == "unique_combination_of_columns":
        keys = ", ".join(rule.columns)
        found = f"SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1"
    elif rule.kind == "relationships":
        parent = f"SELECT {rule.field} FROM {_TABLE_SQL[rule.to]}"
        found = f"SELECT {c} FROM {source} WHERE {c} IS NOT NULL AND {c} NOT IN ({parent})"
    else:
        limit = f"TIMESTAMP '{CTX.run_ts}' - INTERVAL {rule.low} DAY"
        found = f"SELECT max({c}) FROM {source} HAVING max({c}) < {limit}"
    bad = "warn" if rule.severity == "warn" else "error"
    return (
        f"SELECT '{table_name}' AS table_name, '{rule.name}' AS test, '{rule.severity}' AS severity, "
        f"count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE '{bad}' END AS status FROM ({found})"
    )


def _declared_sql() -> str:
    """All declared tests over the expected tables, whose amounts are exact decimals here."""
    rows = {
        "raw_rows": "SELECT *, TIMESTAMP '2016-08-10 06:00:00' AS ingested_at FROM raw",
        "stg_rows": """SELECT * EXCLUDE (transaction_id, customer_id, product_id, transaction_date, product_name, quantity, price, tax),
            tid AS transaction_id, cid AS customer_id, pid AS product_id, day AS transaction_date, pname AS product_name,
            qty AS quantity, price_c / 100.0 AS price, tax_c / 100.0 AS tax,
            CAST(year(day) AS INTEGER) AS transaction_year, month(day) AS transaction_month,
            quarter(day) AS transaction_quarter, qty * price_c / 100.0 AS line_subtotal, tot_c / 100.0 AS line_total,
            TIMESTAMP '2016-08-10 06:00:00' AS ingested_at, 'customer_transactions.csv' AS source_file,
            'run-2016-08-10' AS pipeline_run_id FROM stg""",
        "fact_rows": """SELECT * EXCLUDE (date_key), CAST(date_key AS VARCHAR) AS date_key, price_c / 100.0 AS unit_price,
            sub_c / 100.0 AS line_subtotal, tot_c / 100.0 AS line_total FROM fact""",
    }
    tests = " UNION ALL ".join(_rule_sql(t, r) for t, rules in declared_rules(CTX).items() for r in rules)
    # an equation of two decimals would compare rounded quotients, so it is put in cents
    tests = tests.replace("NOT (line_subtotal = quantity * price)", "NOT (sub_c = quantity * price_c)")
    text = sql("", "raw", "stg", "fact", "dim_customers", "dim_products", "calendar", "monthly", "performance")
    heads = ",\n".join(f"{name} AS ({body})" for name, body in rows.items())
    return f"{text.rstrip()},\n{heads}\n{tests}"


@query("gt24_declared_tests", _declared_sql())
def declared_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = warehouse(spark, sf_dir)
    return run_declared({name: tables.table(name) for name in LAYERS}, CTX)
