"""The declared tests of every table, run in few passes per table.

Rules about single rows become conditional counts in one aggregate. Rules about
values emit only the offending values. Only rules about keys shuffle, and they shuffle
nothing but the key: columns that refer to each other meet in one grouping, which
answers all their rules at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.context import RunContext
from tallyhouse.operators import violations as V
from tallyhouse.quality.grading import Test, grade, store_failures
from tallyhouse.quality.report import QualityError
from tallyhouse.sources.raw import union_all


@dataclass(frozen=True)
class Rule:
    """A declared test of one table. ``kind`` says which arguments it reads."""

    kind: str
    column: str | None = None
    expression: str | None = None
    low: Any = None
    high: Any = None
    values: tuple = ()
    columns: tuple[str, ...] = ()
    to: str | None = None
    field: str | None = None
    where: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        what = self.column or "_".join(self.columns) or "table"
        detail = self.expression or self.to or ""
        slug = "".join(ch if ch.isalnum() else "_" for ch in f"{self.kind} {what} {detail}".strip())
        return slug.strip("_")


def _not_null(*columns: str, **kw: Any) -> list[Rule]:
    return [Rule("not_null", c, **kw) for c in columns]


def _true_or_false(*columns: str) -> list[Rule]:
    return [Rule("accepted_values", c, values=(True, False)) for c in columns]


def _is_true(expression: str, column: str | None = None, **kw: Any) -> Rule:
    return Rule("expression_is_true", column, expression if column is None else f"{column} {expression}", **kw)


def declared_rules(ctx: RunContext) -> dict[str, list[Rule]]:
    """The declared tests, their bounds and accepted texts."""
    return {
        "customer_transactions": [
            Rule("recency", "ingested_at", low=2),
            *_not_null("transaction_id", "transaction_date", "product_id", "product_name", "ingested_at"),
        ],
        "stg_transactions": [
            Rule("unique", "transaction_id"),
            *_not_null(
                "transaction_id", "product_id", "transaction_date", "product_name",
                "ingested_at", "source_file", "pipeline_run_id",
            ),
            _is_true(">= DATE '2010-01-01'", "transaction_date"),
            _is_true(f"<= DATE '{ctx.as_of}'", "transaction_date", severity="warn"),
            Rule("accepted_range", "transaction_month", low=1, high=12),
            Rule("accepted_range", "transaction_quarter", low=1, high=4),
            Rule("accepted_range", "quantity", low=1, high=1000, where="quantity IS NOT NULL"),
            *_not_null("price", where="transaction_id IS NOT NULL", severity="warn"),
            Rule("accepted_range", "price", low=0, high=10000, where="price IS NOT NULL"),
            Rule("accepted_range", "tax", low=0, high=1000, where="tax IS NOT NULL"),
            *_not_null("line_subtotal", where="quantity IS NOT NULL AND price IS NOT NULL"),
            _is_true("= quantity * price", "line_subtotal", where="quantity IS NOT NULL AND price IS NOT NULL"),
            *_not_null("line_total", where="line_subtotal IS NOT NULL AND tax IS NOT NULL"),
            _is_true(">= line_subtotal", "line_total", where="line_subtotal IS NOT NULL AND line_total IS NOT NULL"),
            *_true_or_false(
                "is_missing_transaction_id", "had_transaction_id_prefix", "is_missing_customer_id",
                "had_invalid_date", "had_product_id_prefix", "had_invalid_quantity",
                "had_text_in_price", "had_text_in_tax",
            ),
        ],
        "dim_customers": [
            _is_true("customer_id >= -1"),
            Rule("unique", "customer_id"),
            *_not_null("customer_id", "customer_name", "total_transactions", "total_revenue"),
            _is_true(">= 1", "total_transactions"),
            _is_true(">= 0", "total_revenue"),
            Rule("accepted_values", "customer_value_segment", values=("High Value", "Medium Value", "Low Value")),
            Rule("accepted_values", "customer_tier", values=("Premium", "Standard", "Budget")),
            Rule("accepted_values", "customer_status", values=("Active", "At Risk", "Inactive")),
        ],
        "dim_products": [
            _is_true("total_transactions >= 1"),
            Rule("unique", "product_id"),
            *_not_null("product_id", "product_name", "product_category", "total_revenue", "avg_price"),
            Rule(
                "accepted_values", "product_name",
                values=("PRODUCT A", "PRODUCT B", "PRODUCT C", "PRODUCT D", "PRODUCT E"),
            ),
            Rule("accepted_values", "product_category", values=("CATEGORY 1", "CATEGORY 2", "CATEGORY 3")),
            _is_true("> 0", "total_revenue"),
            Rule("accepted_range", "avg_price", low=0, high=1000),
            Rule(
                "accepted_values", "performance_segment", values=("Top Performer", "Good Performer", "Low Performer")
            ),
        ],
        "dim_dates": [
            Rule("unique", "date_day"),
            *_not_null("date_day", "year", "month", "quarter", "day_of_week", "is_weekend", "is_weekday"),
            Rule("accepted_range", "year", low=2010, high=2030),
            Rule("accepted_range", "month", low=1, high=12),
            Rule("accepted_range", "quarter", low=1, high=4),
            Rule("accepted_range", "day_of_week", low=0, high=6),
            *_true_or_false("is_weekend", "is_weekday"),
        ],
        "fact_transactions": [
            _is_true("line_total >= 0", severity="warn"),
            Rule("unique", "transaction_id"),
            *_not_null(
                "transaction_id", "customer_key", "product_key", "date_key", "quantity",
                "unit_price", "line_total", "data_quality_score", "is_clean_record",
            ),
            Rule("relationships", "customer_key", to="dim_customers", field="customer_id"),
            Rule("relationships", "product_key", to="dim_products", field="product_id"),
            Rule("relationships", "date_key", to="dim_dates", field="date_day"),
            Rule("accepted_range", "quantity", low=0, high=100),
            Rule("accepted_range", "unit_price", low=0, high=10000),
            _is_true(">= line_subtotal", "line_total", where="line_subtotal IS NOT NULL"),
            Rule("accepted_range", "data_quality_score", low=0, high=7),
            *_true_or_false("is_clean_record"),
        ],
        "monthly_customer_summary": [
            Rule("unique_combination_of_columns", columns=("customer_key", "year_month")),
            *_not_null(
                "customer_key", "year_month", "transaction_count", "total_revenue", "monthly_performance_tier"
            ),
            Rule("relationships", "customer_key", to="dim_customers", field="customer_id"),
            _is_true(">= 1", "transaction_count"),
            _is_true(">= 0", "total_revenue"),
            Rule(
                "accepted_values", "monthly_performance_tier",
                values=("High Performer", "Medium Performer", "Low Performer"),
            ),
        ],
        "product_performance": [
            Rule("unique_combination_of_columns", columns=("product_key", "date_key")),
            *_not_null(
                "product_key", "date_key", "total_revenue", "daily_revenue_rank",
                "trend_indicator", "daily_performance_tier",
            ),
            Rule("relationships", "product_key", to="dim_products", field="product_id"),
            Rule("relationships", "date_key", to="dim_dates", field="date_day"),
            _is_true(">= 0", "total_revenue"),
            _is_true(">= 1", "daily_revenue_rank"),
            Rule("accepted_values", "trend_indicator", values=("Above Trend", "On Trend", "Below Trend")),
            Rule(
                "accepted_values", "daily_performance_tier",
                values=("Top Performer", "Good Performer", "Standard Performer"),
            ),
        ],
    }


def as_test(rule: Rule, tables: dict[str, DataFrame], ctx: RunContext) -> Test:
    """The rule as a stand-alone test, whose violations are rows."""
    query = {
        "not_null": lambda df: V.not_null(df, rule.column),
        "expression_is_true": lambda df: V.expression_is_true(df, rule.expression),
        "accepted_range": lambda df: V.accepted_range(df, rule.column, rule.low, rule.high),
        "accepted_values": lambda df: V.accepted_values(df, rule.column, rule.values),
        "unique": lambda df: V.unique(df, rule.column),
        "unique_combination_of_columns": lambda df: V.unique_combination_of_columns(df, rule.columns),
        "relationships": lambda df: V.relationships(df, rule.column, tables[rule.to], rule.field),
        "recency": lambda df: V.recency(df, rule.column, "day", rule.low, ctx.run_ts),
    }[rule.kind]
    return Test(rule.name, query, where=rule.where, severity=rule.severity)


def _row_rule(rule: Rule) -> str | None:
    """The rule as a condition that marks a violating row, where one row decides."""
    if rule.kind == "not_null":
        return f"{rule.column} IS NULL"
    if rule.kind == "expression_is_true":
        return f"NOT ({rule.expression})"
    if rule.kind == "accepted_range":
        bounds = ((">=", rule.low), ("<=", rule.high))
        return " OR ".join(f"NOT ({rule.column} {sign} {bound})" for sign, bound in bounds if bound is not None)
    return None


def _literal(value: Any) -> str:
    return str(value).upper() if isinstance(value, bool) else "'" + str(value).replace("'", "\\'") + "'"


Role = tuple[str, str, str | None]


def _roles(table: str, rule: Rule) -> list[Role]:
    """The columns, with their filters, whose keys a rule looks at: its own, then its parent's."""
    if rule.kind not in ("unique", "relationships"):
        return []
    own = [(table, rule.column, rule.where)]
    return [*own, (rule.to, rule.field, None)] if rule.to else own


def _domains(flat: list[tuple[str, Rule]]) -> list[list[Role]]:
    """Roles whose keys are compared with each other, directly or through a common one."""
    domains: list[list[Role]] = []
    for roles in (_roles(t, r) for t, r in flat):
        if roles:
            met = [d for d in domains if set(d) & set(roles)]
            joined = list(dict.fromkeys([role for d in met for role in d] + roles))
            domains = [d for d in domains if d not in met] + [joined]
    return domains


def _key_pass(domain: list[Role], flat: list[tuple[str, Rule]], tables: dict[str, DataFrame]) -> tuple[set[int], DataFrame]:
    """All rules about the keys of one domain in one grouping: missing, repeated and orphaned ones.

    Every key column is read once and tagged with its role. Equal keys collapse before the
    shuffle to one row with a count per role, so a hot key costs one row a task.
    """
    tagged = [
        tables[t].filter(where or "TRUE").select(F.col(c).alias("key"), F.lit(i).alias("role")) for i, (t, c, where) in enumerate(domain)
    ]
    counts = union_all(tagged).groupBy("key").agg(*[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(len(domain))])
    sums = {}
    for no, (table, rule) in enumerate(flat):
        roles = _roles(table, rule)
        if roles and roles[0] in domain:
            own = domain.index(roles[0])
            if rule.kind == "unique":
                sums[no] = f"count_if(key IS NOT NULL AND n{own} > 1)"
            else:
                sums[no] = f"coalesce(sum(CASE WHEN key IS NOT NULL AND n{domain.index(roles[1])} = 0 THEN n{own} END), 0L)"
        elif rule.kind == "not_null" and (table, rule.column, rule.where) in domain:
            own = domain.index((table, rule.column, rule.where))
            sums[no] = f"coalesce(sum(CASE WHEN key IS NULL THEN n{own} END), 0L)"
    wide = counts.selectExpr(*[f"{e} AS f{no}" for no, e in sums.items()])
    pairs = ", ".join(f"struct({no} AS test_no, f{no} AS failures)" for no in sums)
    return set(sums), wide.selectExpr(f"inline(array({pairs}))")


def _failures(
    df: DataFrame, rules: dict[int, Rule], tables: dict[str, DataFrame], ctx: RunContext
) -> list[DataFrame]:
    """(test number, failures) of the rules of one table, to be summed per test."""
    parts: list[DataFrame] = []
    sums: dict[int, str] = {}
    offending: list[str] = []

    for i, rule in rules.items():
        bad = _row_rule(rule)
        scope = rule.where or "TRUE"
        if bad is not None:
            sums[i] = f"count_if(({scope}) AND ({bad}))"
        elif rule.kind == "accepted_values":
            sums[i] = "0L"
            boolean = isinstance(df.schema[rule.column].dataType, T.BooleanType)
            if not (boolean and set(rule.values) == {True, False}):
                wrong = f"({scope}) AND {rule.column} NOT IN ({', '.join(_literal(v) for v in rule.values)})"
                found = f"struct({i} AS test_no, CAST({rule.column} AS STRING) AS value)"
                offending.append(f"CASE WHEN {wrong} THEN {found} END")
        else:
            found = as_test(rule, tables, ctx).failing_rows(df).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(found.select(F.lit(i).alias("test_no"), "failures"))
    if sums:
        wide = df.selectExpr(*[f"{c} AS f{i}" for i, c in sums.items()])
        pairs = ", ".join(f"struct({i} AS test_no, f{i} AS failures)" for i in sums)
        parts.append(wide.selectExpr(f"inline(array({pairs}))"))
    if offending:
        # good rows emit nothing, so this counts distinct bad values at little cost
        values = df.selectExpr(f"inline(filter(array({', '.join(offending)}), x -> x IS NOT NULL))")
        parts.append(values.distinct().selectExpr("test_no", "1L AS failures"))
    return parts


def run_declared(tables: dict[str, DataFrame], ctx: RunContext, only: Sequence[str] | None = None) -> DataFrame:
    """One row per declared test of ``tables``, or of ``only`` some of them: its failures and its grade."""
    tested = tables if only is None else only
    flat = [(t, r) for t, rules in declared_rules(ctx).items() if t in tested for r in rules]
    parts: list[DataFrame] = []
    keyed: set[int] = set()
    for domain in _domains(flat):
        answered, found = _key_pass(domain, flat, tables)
        keyed |= answered
        parts.append(found)
    for table in dict.fromkeys(t for t, _ in flat):
        rules = {i: r for i, (t, r) in enumerate(flat) if t == table and i not in keyed}
        parts += _failures(tables[table], rules, tables, ctx)
    # about a hundred rows come in, so one small shuffle adds them up
    found = union_all(parts).groupBy("test_no").agg(F.sum("failures").alias("failures"))
    facts = ", ".join(f"struct('{t}' AS table_name, '{r.name}' AS test, '{r.severity}' AS severity)" for t, r in flat)
    named = found.selectExpr(f"inline(array(get(array({facts}), test_no)))", "failures")
    status = F.when(F.col("severity") == "warn", grade(F.col("failures"), "warn")).otherwise(grade(F.col("failures")))
    return named.select("table_name", "test", "severity", "failures", status.alias("status"))


def failing_tests(tables: dict[str, DataFrame], graded: DataFrame, ctx: RunContext) -> dict[str, list[Test]]:
    """The tests worth storing rows of, per table: those that did not pass.

    ``graded`` is what ``run_declared`` gave. There are about a hundred tests, so the
    list of failed ones fits anywhere.
    """
    failed = {(r.table_name, r.test) for r in graded.filter("status <> 'pass'").collect()}
    found = {
        table: [as_test(r, tables, ctx) for r in rules if (table, r.name) in failed]
        for table, rules in declared_rules(ctx).items()
        if table in tables
    }
    return {table: tests for table, tests in found.items() if tests}


class DeclaredTestError(QualityError):
    """A declared test of severity ``error`` failed."""


def barrier(
    layer: str, tested: Sequence[str], tables: dict[str, DataFrame], ctx: RunContext, results: str
) -> tuple[DataFrame, dict[str, str]]:
    """Run the declared tests of one layer; nothing that reads the layer may be built when this raises.

    Grades and failing rows are written below ``results`` first, so that a stopped run
    can be examined. A test graded ``warn`` is stored likewise and lets the run go on.
    Returns the grades and the paths of the failing rows.
    """
    path = f"{results}/declared/layer={layer}"
    run_declared(tables, ctx, tested).write.mode("overwrite").parquet(path)
    graded = next(iter(tables.values())).sparkSession.read.parquet(path)
    stored = {}
    for table, tests in failing_tests(tables, graded, ctx).items():
        paths = store_failures(tests, tables[table], f"{results}/failing_rows/{table}")
        stored |= {f"{table}.{name}": where for name, where in paths.items()}
    failed = [f"{r.table_name}.{r.test}: {r.failures}" for r in graded.filter("status = 'error'").collect()]
    if failed:
        raise DeclaredTestError(f"{layer}: {len(failed)} declared tests failed: {sorted(failed)}")
    return graded, stored
