"""The whole warehouse on a file with the dirt of real exports."""

import csv
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.context import RunContext
from tallyhouse.daily import daily_run
from tallyhouse.plans import reports as R
from tallyhouse.plans.dates import calendar_attributes, dim_dates, observed_spine
from tallyhouse.plans.fact import fact_transactions
from tallyhouse.plans.staging import stg_transactions
from tallyhouse.plans.warehouse import LAYERS, Warehouse
from tallyhouse.quality.declared import DeclaredTestError, declared_rules, failing_tests, run_declared
from tallyhouse.quality.grading import store_failures
from tallyhouse.quality.report import QualityError, gate, quality_report, report_summary
from tallyhouse.sources.raw import (
    RAW_COLUMNS,
    LoadError,
    add_lineage,
    check_input,
    check_loaded,
    freshness,
    load_raw,
    profile,
    read_raw,
    write_landing,
)
from tallyhouse.sources.versions import current, read_table, reconcile, replace_table

ROWS = [
    ("2001", "11.0", "2023-07-05", "201", "Product A", "2.0", "10.00", "1.50"),
    ("2002", "12.0", "2023-07-06", "202", "Product B", "", "40.00", "3.00"),
    ("2003", "", "2023-07-07", "203", "Product C", "3.0", "20.00", "6.00"),
    ("2004", "13.0", "08-07-2023", "204", "Product D", "1.0", "99.99", "0.01"),
    ("2005", "14.0", "2023-07-10", "205", "Product E", "4.0", "Nine", "2.00"),
    ("T2006", "11.0", "2023-07-11", "202", "Product B", "5.0", "30.00", "15.00"),
    ("2007", "12.0", "2023-07-12", "201", "Product A", "2.0", "15.50", "Four"),
    ("2008", "13.0", "2023-07-13", "P204", "Product D", "1.0", "100.00", "5.00"),
    ("T2009", "", "2023-07-14", "203", "Product C", "2.0", "25.00", "2.50"),
]
# with a price for the product that has none above, all declared tests but a warning pass
SOUND = [*ROWS, ("2010", "14.0", "2023-07-10", "205", "Product E", "1.0", "80.00", "4.00")]


def write_csv(path, rows, header=RAW_COLUMNS):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])
    return str(path)


@pytest.fixture(scope="module")
def sample(tmp_path_factory):
    return write_csv(tmp_path_factory.mktemp("in") / "customer_transactions.csv", ROWS)


@pytest.fixture(scope="module")
def built(spark, ctx, sample, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    house = Warehouse(spark, root, lambda: check_input(spark, sample), ctx)
    return house, house.build()


def raw_of(spark, ctx, rows):
    return add_lineage(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS)), ctx)


def by_id(df, *columns):
    return {r["raw_transaction_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_staging_keeps_every_row(built):
    _, tables = built
    assert tables["stg_transactions"].count() == len(ROWS)


def test_cleaned_values(built):
    got = by_id(
        built[1]["stg_transactions"].withColumn("d", F.col("transaction_date").cast("string")),
        "transaction_id", "customer_id", "d", "product_id", "product_name", "quantity", "line_total",
    )
    from decimal import Decimal as D

    assert got["2001"] == (2001, 11, "2023-07-05", 201, "PRODUCT A", 2, D("21.50"))
    assert got["2002"][5:] == (None, None)
    assert got["2003"][1] is None and got["2003"][6] == D("66.00")
    assert got["2004"][2] == "2023-07-08"
    assert got["2005"][6] is None and got["2007"][6] is None
    assert got["T2006"][0] == 2006 and got["T2006"][6] == D("165.00")
    assert got["2008"][3] == 204


def test_fact_admits_complete_rows_and_scores_them(built):
    fact = built[1]["fact_transactions"]
    scores = {r.transaction_id: r.data_quality_score for r in fact.collect()}
    assert scores == {2001: 7, 2003: 6, 2004: 7, 2006: 6, 2008: 6, 2009: 5}
    assert fact.filter("customer_key = -1 AND is_guest_transaction").count() == 2
    assert fact.filter("is_clean_record").count() == 2


def test_dimension_counts_all_rows_while_the_fact_drops_some(built):
    """Totals agree on the sum but not on the count."""
    _, tables = built
    dims = tables["dim_products"].agg(F.sum("total_transactions"), F.sum("total_revenue")).first()
    facts = tables["fact_transactions"].agg(F.count("*"), F.sum("line_total")).first()
    assert dims[0] == 9 and facts[0] == 6
    assert dims[1] == facts[1]


def test_unknown_customer(built):
    row = built[1]["dim_customers"].filter("customer_id = -1").first()
    assert row.customer_name == "Unknown Customer" and row.is_unknown_customer and row.total_transactions == 2


def test_dates_are_the_observed_ones_and_a_week_to_each_side(built):
    days = [str(r.date_day) for r in built[1]["dim_dates"].orderBy("date_day").collect()]
    sold = [f"2023-07-{d:02}" for d in (5, 6, 7, 8, 10, 11, 12, 13, 14)]
    assert days == ["2023-06-28", *sold, "2023-07-21"]


def test_calendar_spells_weeks_and_leaves_names_unpadded(spark):
    row = calendar_attributes(spark.sql("SELECT DATE '2023-07-10' AS date_day")).first()
    assert row.year_week == "2023-228" and row.day_of_week == 1 and row.week_of_year == 28
    assert row.day_name == "Monday" and str(row.quarter_end_date) == "2023-09-30"


def test_no_input_gives_no_dates(spark, ctx):
    empty = stg_transactions(raw_of(spark, ctx, []))
    assert observed_spine(empty).count() == 0
    assert dim_dates(empty, ctx).count() == 0


def test_days_are_whole_numbers_and_dates_stay_dates(built):
    kinds = dict(built[1]["dim_dates"].dtypes)
    assert kinds["date_day"] == "date" and kinds["days_ago"] == "int"


def test_zero_price_gives_null_rates_instead_of_a_failed_build(spark, ctx):
    rows = [("1", "5", "2023-07-11", "101", "Product A", "2", "0.00", "1.00"), ("2", "5", "2023-07-11", "101", "A", "0", "5", "1.00")]
    got = {r.transaction_id: r for r in fact_transactions(stg_transactions(raw_of(spark, ctx, rows)), ctx).collect()}
    assert got[1].tax_rate_percentage is None and got[1].effective_tax_rate is None
    assert got[2].tax_rate_percentage == 20 and got[2].effective_tax_rate is None


def test_renamed_product_gives_two_rows_and_breaks_uniqueness(spark, ctx, tmp_path):
    rows = [(str(i), "5", "2023-07-11", "101", name, "2", "10", "1") for i, name in enumerate("AB")]
    house = Warehouse(spark, str(tmp_path), lambda: raw_of(spark, ctx, rows), ctx)
    tables = {n: house.table(n) for n in LAYERS}
    assert tables["dim_products"].count() == 2
    assert tables["product_performance"].count() == 2
    failed = run_declared(tables, ctx).filter("table_name = 'dim_products' AND test = 'unique_product_id'").first()
    assert (failed.failures, failed.status) == (1, "error")


def test_windows_of_the_daily_performance_carry_few_columns(built):
    house, tables = built
    plan = house.model("product_performance")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) >= 2 and "RepartitionByExpression" not in plan
    # the wide side meets the windows' results only after they are done
    assert all("min_unit_price" not in line for line in windows)
    day = tables["product_performance"].filter("product_key = 202").collect()
    assert [(r.total_revenue, r.daily_revenue_rank, r.revenue_7day_avg, r.trend_indicator) for r in day] == [(165, 1, 165, "On Trend")]


def test_equal_values_have_no_spread(spark, ctx, tmp_path):
    rows = [(str(i), "5", f"2023-0{1 + i % 3}-11", "101", "A", "1", "0.10", "0.20") for i in range(9)]
    house = Warehouse(spark, str(tmp_path), lambda: raw_of(spark, ctx, rows), ctx)
    row = house.table("dim_customers").first()
    assert row.transaction_value_stddev == 0.0 and row.active_months == 3 and row.active_days == 3


def test_spread_over_months_matches_the_builtin(spark, ctx):
    from tallyhouse.plans.customers import customer_metrics

    rows = [(str(i), str(i % 2), f"2023-0{1 + i % 5}-1{i % 7}", "101", "A", "1", str(10 + i * 37 % 101), "0.5") for i in range(60)]
    stg = stg_transactions(raw_of(spark, ctx, rows))
    expected = {r.customer_id: r.s for r in stg.groupBy("customer_id").agg(F.stddev_samp("line_total").alias("s")).collect()}
    got = {r.customer_id: r.transaction_value_stddev for r in customer_metrics(stg, ctx).collect()}
    assert got.keys() == expected.keys()
    for k in expected:
        assert got[k] == pytest.approx(expected[k], rel=1e-12)


def test_staging_as_a_view_gives_the_same_marts(spark, ctx, sample, built, tmp_path):
    view = Warehouse(spark, str(tmp_path), lambda: check_input(spark, sample), ctx, staging_view=True)
    for name in LAYERS:
        a, b = built[1][name], view.table(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_rebuilding_is_idempotent(spark, ctx, sample, built, tmp_path):
    house = Warehouse(spark, str(tmp_path), lambda: check_input(spark, sample), ctx)
    house.build()
    for name, again in house.build().items():
        assert again.exceptAll(built[1][name]).count() == 0, name
        assert again.count() == built[1][name].count(), name


def test_type_one_overwrite_keeps_no_history(spark, ctx, sample, tmp_path):
    house = Warehouse(spark, str(tmp_path), lambda: check_input(spark, sample), ctx)
    house.table("dim_customers")
    later = RunContext(datetime(2023, 7, 22, 6), "run-2", ctx.source_file)
    rows = house.rebuild("dim_customers", later).collect()
    assert {str(r.dim_created_at) for r in rows} == {str(r.dim_updated_at) for r in rows} == {"2023-07-22 06:00:00"}
    assert len(rows) == 5


def test_reports(built):
    _, t = built
    assert R.orphan_report(t["fact_transactions"], t["dim_customers"], t["dim_products"]).filter("orphaned_rows > 0").count() == 0
    split = {r.is_weekend: r.transaction_count for r in R.weekend_split(t["fact_transactions"], t["dim_dates"]).collect()}
    assert split == {True: 1, False: 5}
    assert [r.data_quality_score for r in R.score_distribution(t["fact_transactions"]).collect()] == [7, 6, 5]


# --- loading -------------------------------------------------------------------


def test_missing_texts_become_null(spark, tmp_path):
    path = write_csv(tmp_path / "in.csv", [("1", "NA", "null", "NaN", "None", "n/a", "", "nothing")])
    assert tuple(read_raw(spark, path).first()) == ("1", None, None, None, None, None, None, "nothing")


def test_landing_round_trip_keeps_blanks_and_quotes(spark, ctx, tmp_path):
    rows = [("1", None, '2"3', "4,5", " Product A ", "a\\b", "x", "y")]
    write_landing(raw_of(spark, ctx, rows), str(tmp_path / "landing"))
    assert [tuple(r) for r in read_raw(spark, str(tmp_path / "landing")).collect()] == rows


def test_input_gate(spark, tmp_path):
    with pytest.raises(LoadError):
        check_input(spark, str(tmp_path / "absent.csv"))
    (tmp_path / "empty.csv").touch()
    with pytest.raises(LoadError):
        check_input(spark, str(tmp_path / "empty.csv"))
    wrong = write_csv(tmp_path / "wrong.csv", [("1",) * 8], ["id", *RAW_COLUMNS[1:]])
    with pytest.raises(LoadError):
        check_input(spark, wrong)


def test_profile_counts_repeats_and_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("a", None)], "p string, q string")
    assert profile(df).first().asDict() == {
        "total_rows": 4, "total_columns": 2, "duplicate_rows": 2, "null_p": 0, "null_q": 3,
    }
    assert profile(df.filter("false")).first().total_rows == 0


def test_load_gates(spark, ctx, tmp_path):
    df = raw_of(spark, ctx, ROWS)
    path = str(tmp_path / "raw")
    assert load_raw(spark, df, path, ctx).count() == len(ROWS)
    assert load_raw(spark, df, path, ctx).count() == len(ROWS)
    assert replace_table(df.limit(3), str(tmp_path / "other")) == 3
    with pytest.raises(LoadError):
        reconcile(spark, path, 1)
    with pytest.raises(LoadError):
        check_loaded(df.drop("tax"))
    with pytest.raises(LoadError):
        check_loaded(df.filter("false"))


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(LoadError):
        read_table(spark, path)
    replace_table(spark.range(3), path)
    lost = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        replace_table(lost, path)
    assert read_table(spark, path).count() == 3
    # a table may be replaced by what is read from it
    begun = read_table(spark, path)
    assert replace_table(begun.withColumn("id", F.col("id") * 2), path) == 3
    assert sorted(r.id for r in read_table(spark, path).collect()) == [0, 2, 4]
    assert sorted(r.id for r in begun.collect()) == [0, 1, 2]
    assert len(list((tmp_path / "t").glob("v*"))) == 2 and current(spark, path).endswith("v00000003")
    replace_table(spark.range(7).withColumn("day", F.col("id") % 2), path, ["day"])
    assert read_table(spark, path).filter("day = 1").count() == 3 and len(list((tmp_path / "t").glob("v*"))) == 2


def test_padded_names_reach_the_calendar(spark, ctx, sample, tmp_path):
    house = Warehouse(spark, str(tmp_path), lambda: check_input(spark, sample), ctx, padded_names=True)
    row = house.table("dim_dates").filter("date_day = DATE '2023-07-05'").first()
    assert row.day_name == "Wednesday" and row.month_name == "July     "


@pytest.mark.parametrize("hours, status", [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(spark, ctx, hours, status):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ '2023-07-21 06:00:00' - INTERVAL {hours} HOURS AS ingested_at")
    assert freshness(df, "ingested_at", ctx).first().status == status
    assert freshness(df.filter("false"), "ingested_at", ctx).first().status == "error"


# --- quality -------------------------------------------------------------------


def test_daily_run(spark, ctx, tmp_path):
    files = write_csv(tmp_path / "sound.csv", SOUND)
    outcome = daily_run(spark, files, str(tmp_path / "out"), ctx)
    assert outcome.report["total_checks"] == 25
    # a warning is stored and lets the run go on
    assert outcome.tests == {"pass": 112, "warn": 1}
    assert list(outcome.failing_rows) == ["stg_transactions.not_null_price"]
    assert spark.read.parquet(outcome.failing_rows["stg_transactions.not_null_price"]).count() == 1
    assert outcome.profile["total_rows"] == 10 and outcome.profile["duplicate_rows"] == 0 and outcome.profile["null_quantity"] == 1
    layers = spark.read.parquet(str(tmp_path / "out/test_results/declared")).groupBy("layer").count().collect()
    assert {r["layer"] for r in layers} == {"raw", "staging", "mart"}


def test_an_error_in_staging_stops_before_the_marts(spark, ctx, tmp_path):
    out = tmp_path / "out"
    with pytest.raises(DeclaredTestError, match="staging: 1 .*unique_transaction_id: 1"):
        daily_run(spark, write_csv(tmp_path / "twice.csv", [SOUND[0], *SOUND]), str(out), ctx)
    assert (out / "staging").exists() and not (out / "mart").exists() and not (out / "test_results/report").exists()
    found = spark.read.parquet(str(out / "test_results/failing_rows/stg_transactions/unique_transaction_id"))
    assert [r["unique_field"] for r in found.collect()] == [2001]
    assert spark.read.parquet(str(out / "test_results/profile")).first().duplicate_rows == 1
    # the next sound run builds what the stopped one left out
    assert daily_run(spark, write_csv(tmp_path / "sound.csv", SOUND), str(out), ctx).report["failed_checks"] == 0


def test_an_error_in_the_marts_stops_before_the_report(spark, ctx, sample, tmp_path):
    out = tmp_path / "out"
    with pytest.raises(DeclaredTestError, match="mart: 2 .*dim_products.not_null_avg_price: 1"):
        daily_run(spark, sample, str(out), ctx)
    assert (out / "mart/product_performance").exists() and not (out / "test_results/report").exists()
    graded = spark.read.parquet(str(out / "test_results/declared")).filter("layer = 'mart' AND status = 'error'")
    assert graded.count() == 2


def test_profile_counts_missing_values_in_their_own_columns(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), ("a", "a")], "p string, q string")
    assert profile(df).first().asDict() == {"total_rows": 4, "total_columns": 2, "duplicate_rows": 1, "null_p": 2, "null_q": 1}


def test_report_passes_on_clean_marts_and_counts_25_checks(built):
    summary = gate(quality_report(built[1]))
    assert summary["total_checks"] == 25 and summary["pass_rate"] == 100.0


def test_gate_raises_on_a_seeded_failure(spark, ctx, tmp_path):
    rows = ROWS + [ROWS[0]]
    house = Warehouse(spark, str(tmp_path), lambda: raw_of(spark, ctx, rows), ctx)
    report = quality_report({n: house.table(n) for n in LAYERS})
    assert report_summary(report).first().failed_checks == 2
    with pytest.raises(QualityError, match="unique"):
        gate(report)


def test_declared_suite(built, ctx):
    results = run_declared(built[1], ctx).collect()
    assert len(results) == sum(len(r) for r in declared_rules(ctx).values())
    names = [(r.table_name, r.test) for r in results]
    assert len(set(names)) == len(names)
    bad = {(r.test, r.failures, r.status) for r in results if r.status != "pass"}
    # the only sale of product 205 has its price as text
    assert bad == {
        ("not_null_price", 1, "warn"),
        ("not_null_avg_price", 1, "error"),
        ("expression_is_true_total_revenue_total_revenue___0", 1, "error"),
    }


def test_rows_of_failed_tests_are_stored(spark, built, ctx, tmp_path):
    _, tables = built
    failed = failing_tests(tables, run_declared(tables, ctx), ctx)
    assert [t.name for t in failed["stg_transactions"]] == ["not_null_price"]
    paths = store_failures(failed["stg_transactions"], tables["stg_transactions"], str(tmp_path))
    assert spark.read.parquet(paths["not_null_price"]).first().raw_transaction_id == "2005"


def test_declared_suite_counts_failures_of_every_kind(spark, ctx):
    bad = spark.createDataFrame(
        [("odd", -5, None, 2), ("odd", 0, "x", 2), ("High Value", 3, None, None), ("worse", 1, "y", 9)],
        "customer_value_segment string, total_transactions int, customer_name string, customer_id int",
    ).selectExpr("*", "1 AS total_revenue", "'Budget' AS customer_tier", "'Active' AS customer_status")
    got = {r.test: r.failures for r in run_declared({"dim_customers": bad}, ctx).collect()}
    assert got["accepted_values_customer_value_segment"] == 2
    assert got["unique_customer_id"] == 1
    assert got["not_null_customer_id"] == 1
    assert got["not_null_customer_name"] == 2
    assert [v for k, v in got.items() if k.startswith("expression_is_true_total_transactions")] == [2]


def test_queries_read_staging_as_a_view(spark):
    """The wide staging table is not written for queries that need a part of it."""
    from tallyhouse.registry.common import warehouse

    tables = warehouse(spark, "/root/testdata/sf0.001")
    staged = tables.table("stg_transactions")
    assert not any("/staging/" in f for f in staged.inputFiles())
    assert staged.count() == tables.table("customer_transactions").count()
