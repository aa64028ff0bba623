"""SQL for the comparison engine, put together from shared table expressions.

Amounts are whole cents there, and roundings are integer divisions, so that the
expected values are exact.
"""

from __future__ import annotations

TODAY = "DATE '2016-08-10'"


def rounded(numerator: str, denominator: str, digits: int = 2) -> str:
    """Half-up rounding of a quotient of non-negative integers; NULL for divisor 0."""
    scale = 10**digits
    return (
        f"CASE WHEN ({denominator}) = 0 THEN NULL ELSE "
        f"CAST((2 * {scale} * ({numerator}) + ({denominator})) // (2 * ({denominator})) AS DOUBLE) / {scale} END"
    )


def money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def text_of(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


CTES: dict[str, tuple[list[str], str]] = {}

CTES["base"] = (
    [],
    """
    SELECT l.ok * 7 + l.ln - 1 AS id, l.ok, l.ln, l.pk, l.q, o.o_custkey AS ck,
           CAST(o.o_orderdate AS DATE) + 5479 AS d
    FROM (SELECT l_orderkey AS ok, l_linenumber AS ln, max(l_partkey) AS pk, max(CAST(l_quantity AS INTEGER)) AS q
          FROM lineitem GROUP BY l_orderkey, l_linenumber) l
    JOIN orders o ON l.ok = o.o_orderkey""",
)


def _cents_text(cents: str) -> str:
    return f"CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0')"


CTES["raw"] = (
    ["base"],
    f"""
    SELECT CASE WHEN id % 10 = 0 THEN 'T' ELSE '' END || CAST(id AS VARCHAR) AS transaction_id,
           CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(ck AS VARCHAR) || '.0' END AS customer_id,
           CASE WHEN id % 8 = 0 THEN strftime(d, '%d-%m-%Y') ELSE strftime(d, '%Y-%m-%d') END AS transaction_date,
           CASE WHEN id % 15 = 0 THEN 'P' ELSE '' END || CAST(100 + pk % 50 AS VARCHAR) AS product_id,
           ' Product ' || substr('EABCD', CAST(pk % 5 + 1 AS INTEGER), 1) AS product_name,
           CASE WHEN id % 6 = 0 THEN NULL ELSE CAST(1 + q % 5 AS VARCHAR) || '.0' END AS quantity,
           CASE WHEN id % 9 = 0 THEN 'Two Hundred' ELSE {_cents_text('5000 + (pk * 7919 + ok * 31) % 25000')} END AS price,
           CASE WHEN id % 11 = 0 THEN 'Fifteen' ELSE {_cents_text('500 + (ok * 13 + ln) % 2500')} END AS tax
    FROM base""",
)

CTES["typed"] = (
    ["raw"],
    r"""
    SELECT *,
           transaction_id IS NULL OR trim(transaction_id) = '' AS is_missing_transaction_id,
           coalesce(regexp_full_match(transaction_id, 'T[0-9]+'), FALSE) AS had_transaction_id_prefix,
           customer_id IS NULL OR trim(customer_id) = '' AS is_missing_customer_id,
           transaction_date IS NULL OR trim(transaction_date) = '' AS is_missing_transaction_date,
           coalesce(regexp_full_match(product_id, 'P[0-9]+'), FALSE) AS had_product_id_prefix,
           quantity IS NULL OR NOT regexp_full_match(quantity, '[0-9]+\.?[0-9]*') AS had_invalid_quantity,
           coalesce(regexp_matches(price, '[A-Za-z]'), FALSE) AS had_text_in_price,
           coalesce(regexp_matches(tax, '[A-Za-z]'), FALSE) AS had_text_in_tax,
           CASE WHEN regexp_full_match(transaction_id, '[0-9]+') THEN CAST(transaction_id AS BIGINT)
                WHEN regexp_full_match(transaction_id, 'T[0-9]+') THEN CAST(substr(transaction_id, 2) AS BIGINT)
           END AS tid,
           CASE WHEN regexp_full_match(customer_id, '[0-9]+\.?[0-9]*')
                THEN CAST(split_part(customer_id, '.', 1) AS BIGINT) END AS cid,
           CASE WHEN regexp_full_match(transaction_date, '\d{4}-\d{2}-\d{2}') THEN TRY_CAST(transaction_date AS DATE)
                WHEN regexp_full_match(transaction_date, '\d{2}-\d{2}-\d{4}')
                THEN CAST(try_strptime(transaction_date, '%d-%m-%Y') AS DATE) END AS day,
           CASE WHEN regexp_full_match(product_id, '[0-9]+') THEN CAST(product_id AS BIGINT)
                WHEN regexp_full_match(product_id, 'P[0-9]+') THEN CAST(substr(product_id, 2) AS BIGINT) END AS pid,
           upper(trim(product_name)) AS pname,
           CASE WHEN regexp_full_match(quantity, '[0-9]+\.?[0-9]*')
                THEN CAST(split_part(quantity, '.', 1) AS INTEGER) END AS qty,
           CASE WHEN regexp_full_match(price, '[0-9]+\.?[0-9]*')
                THEN CAST(CAST(price AS DECIMAL(10,2)) * 100 AS BIGINT) END AS price_c,
           CASE WHEN regexp_full_match(tax, '[0-9]+\.?[0-9]*')
                THEN CAST(CAST(tax AS DECIMAL(10,2)) * 100 AS BIGINT) END AS tax_c
    FROM raw""",
)

CTES["stg"] = (
    ["typed"],
    """
    SELECT *, day IS NULL AS had_invalid_date, qty * price_c AS sub_c, qty * price_c + tax_c AS tot_c,
           coalesce(qty > 3, FALSE) AS is_bulk_purchase
    FROM typed""",
)

CTES["customer_metrics"] = (
    ["stg"],
    f"""
    SELECT coalesce(cid, -1) AS customer_id, min(day) AS first_day, max(day) AS last_day, count(*) AS n,
           count(DISTINCT date_trunc('month', day)) AS months, count(DISTINCT day) AS days,
           count(CASE WHEN is_bulk_purchase THEN 1 END) AS bulk, sum(coalesce(tot_c, 0)) AS rev_c,
           min(coalesce(tot_c, 0)) AS min_c, max(coalesce(tot_c, 0)) AS max_c,
           round(stddev_samp(CAST(coalesce(tot_c, 0) AS DOUBLE) / 100), 6) AS sd,
           date_diff('day', max(day), {TODAY}) AS idle
    FROM stg WHERE tid IS NOT NULL GROUP BY coalesce(cid, -1)""",
)

CTES["dim_customers"] = (
    ["customer_metrics"],
    f"""
    SELECT customer_id,
           CASE WHEN customer_id = -1 THEN 'Unknown Customer' ELSE 'Customer ' || customer_id END AS customer_name,
           customer_id = -1 AS is_unknown_customer,
           CAST(first_day AS VARCHAR) AS first_transaction_date, CAST(last_day AS VARCHAR) AS last_transaction_date,
           CAST(date_diff('day', first_day, last_day) AS INTEGER) AS customer_tenure_days,
           n AS total_transactions, months AS active_months, days AS active_days, bulk AS bulk_purchase_count,
           {rounded('100 * bulk', 'n')} AS bulk_purchase_percentage,
           {money('rev_c')} AS total_revenue, {money('rev_c')} / n AS avg_transaction_value,
           {money('min_c')} AS min_transaction_value, {money('max_c')} AS max_transaction_value,
           sd AS transaction_value_stddev, CAST(idle AS INTEGER) AS days_since_last_transaction,
           CASE WHEN idle <= 7 THEN 'Active' WHEN idle <= 14 THEN 'At Risk' ELSE 'Inactive' END AS customer_status,
           CASE WHEN rev_c > 150000 THEN 'High Value' WHEN rev_c > 80000 THEN 'Medium Value'
                ELSE 'Low Value' END AS customer_value_segment,
           CASE WHEN rev_c > 20000 * n THEN 'Premium' WHEN rev_c > 10000 * n THEN 'Standard'
                ELSE 'Budget' END AS customer_tier
    FROM customer_metrics""",
)

CTES["product_metrics"] = (
    ["stg"],
    """
    SELECT pid AS product_id, pname AS product_name, count(*) AS n, sum(coalesce(qty, 0)) AS qty,
           count(price_c) AS n_price, sum(price_c) AS price_c, min(price_c) AS min_c, max(price_c) AS max_c,
           round(stddev_samp(CAST(price_c AS DOUBLE) / 100), 6) AS sd,
           count(tax_c) AS n_tax, sum(tax_c) AS tax_c, sum(coalesce(tot_c, 0)) AS rev_c,
           min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS days,
           avg(CASE WHEN price_c > 0 THEN CAST(tax_c AS DOUBLE) / price_c END) AS rate
    FROM stg WHERE tid IS NOT NULL AND pid IS NOT NULL GROUP BY pid, pname""",
)

CTES["dim_products"] = (
    ["product_metrics"],
    f"""
    SELECT product_id, product_name,
           CASE WHEN product_name IN ('PRODUCT A', 'PRODUCT B') THEN 'CATEGORY 1'
                WHEN product_name IN ('PRODUCT C', 'PRODUCT D') THEN 'CATEGORY 2' ELSE 'CATEGORY 3'
           END AS product_category,
           n AS total_transactions, CAST(qty AS BIGINT) AS total_quantity_sold,
           CAST(qty AS DOUBLE) / n AS avg_quantity_per_transaction,
           {money('price_c')} / n_price AS avg_price, {money('min_c')} AS min_price, {money('max_c')} AS max_price,
           sd AS price_stddev, {money('max_c - min_c')} AS price_range, {money('tax_c')} / n_tax AS avg_tax,
           {money('tax_c')} AS total_tax_collected, round(rate * 100, 2) AS avg_tax_rate_percentage,
           {money('rev_c')} AS total_revenue, {money('rev_c')} / n AS avg_transaction_revenue,
           {rounded('rev_c', '100 * n')} AS revenue_per_transaction,
           {rounded('rev_c', '100 * qty')} AS revenue_per_unit,
           CAST(first_day AS VARCHAR) AS first_sale_date, CAST(last_day AS VARCHAR) AS last_sale_date,
           days AS days_with_sales, CAST(date_diff('day', last_day, {TODAY}) AS INTEGER) AS days_since_last_sale,
           CASE WHEN rev_c > 300000 THEN 'Top Performer' WHEN rev_c > 150000 THEN 'Good Performer'
                ELSE 'Low Performer' END AS performance_segment,
           CASE WHEN price_c > 20000 * n_price THEN 'Premium' WHEN price_c > 10000 * n_price THEN 'Mid-Range'
                ELSE 'Budget' END AS price_segment,
           CASE WHEN sd / ({money('price_c')} / n_price) > 0.3 THEN 'High Variability'
                WHEN sd / ({money('price_c')} / n_price) > 0.1 THEN 'Medium Variability'
                ELSE 'Low Variability' END AS price_stability,
           coalesce(date_diff('day', last_day, {TODAY}) > 7, FALSE) AS is_slow_moving
    FROM product_metrics""",
)

CTES["spine"] = (
    ["stg"],
    """
    SELECT day AS date_day FROM stg WHERE day IS NOT NULL
    UNION SELECT min(day) - 7 FROM stg
    UNION SELECT max(day) + 7 FROM stg""",
)

CTES["calendar"] = (
    ["spine"],
    f"""
    SELECT date_day AS day_value, CAST(date_day AS VARCHAR) AS date_day,
           CAST(year(date_day) AS INTEGER) AS year, CAST(month(date_day) AS INTEGER) AS month,
           CAST(day(date_day) AS INTEGER) AS day, CAST(quarter(date_day) AS INTEGER) AS quarter,
           CAST(weekofyear(date_day) AS INTEGER) AS week_of_year, CAST(dayofweek(date_day) AS INTEGER) AS day_of_week,
           CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
           strftime(date_day, '%A') AS day_name, strftime(date_day, '%a') AS day_name_short,
           strftime(date_day, '%B') AS month_name, strftime(date_day, '%b') AS month_name_short,
           strftime(date_day, '%Y-%m') AS year_month,
           year(date_day) || '-Q' || quarter(date_day) AS year_quarter,
           year(date_day) || '-' || ((day(date_day) - 1) // 7 + 1)
               || lpad(CAST((dayofyear(date_day) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS year_week,
           CAST(CAST(date_trunc('week', date_day) AS DATE) AS VARCHAR) AS week_start_date,
           CAST(CAST(date_trunc('week', date_day) AS DATE) + 6 AS VARCHAR) AS week_end_date,
           CAST(CAST(date_trunc('month', date_day) AS DATE) AS VARCHAR) AS month_start_date,
           CAST(CAST(date_trunc('month', date_day) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR)
               AS month_end_date,
           CAST(CAST(date_trunc('quarter', date_day) AS DATE) AS VARCHAR) AS quarter_start_date,
           CAST(CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR)
               AS quarter_end_date,
           CAST(CAST(date_trunc('year', date_day) AS DATE) AS VARCHAR) AS year_start_date,
           CAST(CAST(date_trunc('year', date_day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS VARCHAR)
               AS year_end_date,
           dayofweek(date_day) IN (0, 6) AS is_weekend, dayofweek(date_day) NOT IN (0, 6) AS is_weekday,
           day(date_day) = 1 AS is_month_start, day(date_day + 1) = 1 AS is_month_end,
           month(date_day) = 8 AND year(date_day) = 2016 AS is_current_month, year(date_day) = 2016 AS is_current_year,
           CASE WHEN date_day = {TODAY} THEN 'Today' WHEN date_day = {TODAY} - 1 THEN 'Yesterday'
                WHEN date_day > {TODAY} - 7 AND date_day < {TODAY} THEN 'Last 7 Days'
                WHEN date_day > {TODAY} - 30 AND date_day < {TODAY} THEN 'Last 30 Days'
                WHEN date_day > {TODAY} THEN 'Future' ELSE 'Historical' END AS relative_period,
           CAST(date_diff('day', date_day, {TODAY}) AS INTEGER) AS days_ago,
           CAST(date_diff('day', {TODAY}, date_day) AS INTEGER) AS days_ahead
    FROM spine""",
)

_FLAGS = [
    "had_transaction_id_prefix",
    "is_missing_customer_id",
    "had_invalid_date",
    "had_product_id_prefix",
    "had_invalid_quantity",
    "had_text_in_price",
    "had_text_in_tax",
]

CTES["fact"] = (
    ["stg"],
    f"""
    SELECT tid AS transaction_id, coalesce(cid, -1) AS customer_key, pid AS product_key, day AS date_key,
           pname AS product_name, qty AS quantity, price_c, tax_c, sub_c, tot_c, is_bulk_purchase,
           cid IS NULL AS is_guest_transaction, qty > 1 AS is_multi_item, price_c > 20000 AS is_premium_price,
           tot_c > 50000 AS is_high_value_transaction, {', '.join(_FLAGS)},
           7 - {' - '.join(f'CAST({f} AS INTEGER)' for f in _FLAGS)} AS data_quality_score,
           NOT ({' OR '.join(_FLAGS)}) AS is_clean_record
    FROM stg WHERE tid IS NOT NULL AND pid IS NOT NULL AND day IS NOT NULL AND tot_c IS NOT NULL""",
)

CTES["monthly_metrics"] = (
    ["fact"],
    """
    SELECT customer_key, strftime(date_key, '%Y-%m') AS year_month, CAST(year(date_key) AS INTEGER) AS year,
           CAST(month(date_key) AS INTEGER) AS month, CAST(quarter(date_key) AS INTEGER) AS quarter,
           year(date_key) || '-Q' || quarter(date_key) AS year_quarter, count(*) AS n,
           count(DISTINCT date_key) AS days, count(DISTINCT product_key) AS products, sum(quantity) AS qty,
           sum(sub_c) AS sub_c, sum(tax_c) AS tax_c, sum(tot_c) AS rev_c, min(tot_c) AS min_c, max(tot_c) AS max_c,
           sum(CAST(is_bulk_purchase AS INTEGER)) AS bulk, sum(CAST(is_high_value_transaction AS INTEGER)) AS high,
           sum(CAST(is_premium_price AS INTEGER)) AS premium, sum(data_quality_score) AS score,
           sum(CAST(is_clean_record AS INTEGER)) AS clean
    FROM fact GROUP BY ALL""",
)

CTES["monthly"] = (
    ["monthly_metrics", "dim_customers"],
    f"""
    SELECT customer_key, year_month, year, month, quarter, year_quarter, c.customer_name, c.is_unknown_customer,
           c.customer_value_segment, c.customer_tier, n AS transaction_count, days AS active_days,
           products AS unique_products_purchased, CAST(qty AS BIGINT) AS total_quantity,
           CAST(qty AS DOUBLE) / n AS avg_quantity_per_transaction, {money('sub_c')} AS total_subtotal,
           {money('tax_c')} AS total_tax, {money('rev_c')} AS total_revenue,
           {money('rev_c')} / n AS avg_transaction_value, {money('min_c')} AS min_transaction_value,
           {money('max_c')} AS max_transaction_value, {rounded('rev_c', '100 * n')} AS revenue_per_transaction,
           {rounded('rev_c', '100 * days')} AS revenue_per_active_day, CAST(bulk AS BIGINT) AS bulk_purchase_count,
           {rounded('100 * bulk', 'n')} AS bulk_purchase_rate, CAST(high AS BIGINT) AS high_value_transaction_count,
           {rounded('100 * high', 'n')} AS high_value_transaction_rate, CAST(premium AS BIGINT) AS premium_price_count,
           CAST(score AS DOUBLE) / n AS avg_data_quality_score, CAST(clean AS BIGINT) AS clean_record_count,
           CASE WHEN rev_c > 50000 THEN 'High Performer' WHEN rev_c > 20000 THEN 'Medium Performer'
                ELSE 'Low Performer' END AS monthly_performance_tier
    FROM monthly_metrics m LEFT JOIN dim_customers c ON m.customer_key = c.customer_id""",
)

CTES["daily"] = (
    ["fact"],
    """
    SELECT product_key, date_key, count(*) AS n, count(DISTINCT customer_key) AS customers, sum(quantity) AS qty,
           sum(sub_c) AS sub_c, sum(tax_c) AS tax_c, sum(tot_c) AS rev_c, sum(price_c) AS price_c,
           min(price_c) AS min_c, max(price_c) AS max_c, sum(sub_c) * 3 AS margin_m,
           sum(CAST(is_bulk_purchase AS INTEGER)) AS bulk, sum(CAST(is_guest_transaction AS INTEGER)) AS guest
    FROM fact GROUP BY product_key, date_key""",
)

CTES["rolling"] = (
    ["daily"],
    """
    SELECT *, sum(rev_c) OVER week AS rev7, sum(qty) OVER week AS qty7, sum(n) OVER week AS n7, count(*) OVER week AS k7,
           rank() OVER (PARTITION BY date_key ORDER BY rev_c DESC) AS rnk
    FROM daily
    WINDOW week AS (PARTITION BY product_key ORDER BY date_key
                    RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
)

DAILY_COLUMNS = f"""
           n AS transaction_count, customers AS unique_customers, CAST(qty AS BIGINT) AS total_quantity,
           CAST(qty AS DOUBLE) / n AS avg_quantity_per_transaction, {money('sub_c')} AS total_subtotal,
           {money('tax_c')} AS total_tax, {money('rev_c')} AS total_revenue, {money('price_c')} / n AS avg_unit_price,
           {money('min_c')} AS min_unit_price, {money('max_c')} AS max_unit_price,
           CAST(margin_m AS DOUBLE) / 1000 AS total_estimated_margin,
           CAST(bulk AS BIGINT) AS bulk_purchase_count, CAST(guest AS BIGINT) AS guest_purchase_count"""
RATIO_COLUMNS = f"""
           {rounded('rev_c', '100 * n')} AS revenue_per_transaction, {rounded('rev_c', '100 * qty')} AS revenue_per_unit,
           {rounded('10 * margin_m', 'rev_c')} AS margin_percentage, {rounded('100 * bulk', 'n')} AS bulk_purchase_rate,
           {rounded('100 * guest', 'n')} AS guest_purchase_rate, {money('max_c - min_c')} AS price_variance,
           {rounded('(max_c - min_c) * 100 * n', 'price_c')} AS price_variance_percentage"""
ROLLING_COLUMNS = f"""
           {rounded('rev7', '100 * k7')} AS revenue_7day_avg, {rounded('qty7', 'k7')} AS quantity_7day_avg,
           {rounded('n7', 'k7')} AS transaction_count_7day_avg"""
TREND_COLUMN = """
           CASE WHEN rev_c * 10 * k7 > rev7 * 12 THEN 'Above Trend' WHEN rev_c * 10 * k7 < rev7 * 8 THEN 'Below Trend'
                ELSE 'On Trend' END AS trend_indicator"""
TIER_COLUMN = """
           CASE WHEN rnk <= 2 THEN 'Top Performer' WHEN rnk <= 4 THEN 'Good Performer'
                ELSE 'Standard Performer' END AS daily_performance_tier"""

CTES["performance"] = (
    ["rolling", "calendar", "dim_products"],
    f"""
    SELECT r.product_key, CAST(r.date_key AS VARCHAR) AS date_key, p.product_name, p.product_category,
           p.performance_segment, p.price_segment, p.price_stability,
           d.year, d.month, d.quarter, d.year_month, d.week_of_year, d.day_name, d.is_weekend,
           {DAILY_COLUMNS}, {RATIO_COLUMNS}, {ROLLING_COLUMNS}, CAST(rnk AS INTEGER) AS daily_revenue_rank,
           {TREND_COLUMN}, {TIER_COLUMN}
    FROM rolling r JOIN calendar d ON r.date_key = d.day_value LEFT JOIN dim_products p ON r.product_key = p.product_id""",
)


def sql(body: str, *tables: str) -> str:
    """``body`` behind the table expressions it names, in an order that works."""
    order: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for need in needs:
            add(need)
        if name not in order:
            order.append(name)

    for name in tables:
        add(name)
    heads = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {heads}\n{body.strip()}" if heads else body.strip()
