"""Check SQL for the sales and customer reports."""

from __future__ import annotations

from basketlens.oracles.star_sql import big, dbl, int_, pct, per, query, rnd

TOTAL = "(SELECT SUM(revenue_usd) FROM fact_sales)"
LAST_YEAR = "(SELECT year(MAX(order_date)) FROM fact_sales)"
PRODUCT_JOIN = "JOIN flat p ON f.product_key = p.product_key"
COMPLETENESS = (
    f"CASE WHEN year = {LAST_YEAR} THEN 'PARTIAL YEAR' ELSE 'FULL YEAR' END AS year_completeness"
)


def _growth(col: str, over: str) -> str:
    before = f"LAG({col}) OVER ({over})"
    return pct(f"({col} - {before})", before)


def sales_oracles() -> dict[str, str]:
    sql = {}
    sql["kpi_summary"] = query(f"""
SELECT {dbl("SUM(revenue_usd)")} AS total_revenue_usd,
  COUNT(DISTINCT order_number) AS total_orders,
  COUNT(DISTINCT customer_key) AS total_customers_who_ordered,
  {big("SUM(quantity)")} AS total_units_sold,
  {per("SUM(revenue_usd)", "COUNT(DISTINCT order_number)")} AS avg_order_value_usd,
  {per("SUM(revenue_usd)", "COUNT(DISTINCT customer_key)")} AS avg_revenue_per_customer_usd
FROM fact_sales""")
    sql["monthly_revenue_and_growth"] = query(
        f"""
SELECT year_month, {dbl("r")} AS revenue_usd, orders,
  {dbl("r - LAG(r) OVER (ORDER BY year_month)")} AS revenue_change_usd,
  {_growth("r", "ORDER BY year_month")} AS mom_growth_pct
FROM monthly ORDER BY year_month""",
        """
monthly AS (
  SELECT strftime(order_date, '%Y-%m') AS year_month, SUM(revenue_usd) AS r,
    COUNT(DISTINCT order_number) AS orders
  FROM fact_sales GROUP BY 1
)""",
    )
    sql["yearly_revenue_and_growth"] = query(
        f"""
SELECT year, {dbl("r")} AS revenue_usd, orders,
  {_growth("r", "ORDER BY year")} AS yoy_growth_pct, {COMPLETENESS}
FROM yearly ORDER BY year""",
        f"""
yearly AS (
  SELECT {int_("year(order_date)")} AS year, SUM(revenue_usd) AS r,
    COUNT(DISTINCT order_number) AS orders
  FROM fact_sales GROUP BY 1
)""",
    )
    product = """
product AS (
  SELECT f.product_key, p.product_name, p.brand, p.category_name,
    SUM(f.revenue_usd) AS r, SUM(f.profit_usd) AS pr, SUM(f.quantity) AS q
  FROM fact_sales f JOIN flat p ON f.product_key = p.product_key
  GROUP BY 1, 2, 3, 4
)"""
    sql["top_10_products_by_revenue"] = query(
        f"""
SELECT product_name, brand, category_name, {dbl("r")} AS total_revenue_usd,
  {big("q")} AS total_units_sold,
  {int_("RANK() OVER (ORDER BY r DESC)")} AS revenue_rank
FROM product ORDER BY r DESC, product_key LIMIT 10""",
        product,
    )
    sql["top_10_products_by_quantity"] = query(
        f"""
SELECT product_name, brand, category_name, {big("q")} AS total_units_sold,
  {dbl("r")} AS total_revenue_usd,
  {int_("RANK() OVER (ORDER BY q DESC)")} AS quantity_rank
FROM product ORDER BY q DESC, product_key LIMIT 10""",
        product,
    )
    sql["bottom_10_products_by_revenue"] = query(
        f"""
SELECT product_name, brand, category_name, {dbl("r")} AS total_revenue_usd,
  {big("q")} AS total_units_sold
FROM product ORDER BY r ASC, product_key LIMIT 10""",
        product,
    )
    sql["products_never_sold"] = query("""
SELECT COUNT(*) AS products_never_sold
FROM dim_product p LEFT JOIN fact_sales f ON p.product_key = f.product_key
WHERE f.product_key IS NULL""")
    sql["category_revenue"] = query(f"""
SELECT p.category_name, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  {big("SUM(f.quantity)")} AS total_units_sold,
  COUNT(DISTINCT f.order_number) AS orders_containing_category,
  {pct("SUM(f.revenue_usd)", TOTAL)} AS pct_of_total_revenue,
  {int_("RANK() OVER (ORDER BY SUM(f.revenue_usd) DESC)")} AS revenue_rank
FROM fact_sales f {PRODUCT_JOIN}
GROUP BY p.category_name""")
    sql["category_growth_yoy"] = query(
        f"""
SELECT category_name, year, {dbl("r")} AS revenue_usd,
  {_growth("r", "PARTITION BY category_name ORDER BY year")} AS yoy_growth_pct
FROM cat_year""",
        f"""
cat_year AS (
  SELECT p.category_name, {int_("year(f.order_date)")} AS year, SUM(f.revenue_usd) AS r
  FROM fact_sales f {PRODUCT_JOIN}
  WHERE year(f.order_date) <> {LAST_YEAR}
  GROUP BY 1, 2
)""",
    )
    sql["product_profitability_top10"] = query(
        f"""
SELECT product_name, category_name, {dbl("r")} AS total_revenue_usd,
  {dbl("pr")} AS total_profit_usd, {pct("pr", "r")} AS profit_margin_pct
FROM product ORDER BY pr DESC, product_key LIMIT 10""",
        product,
    )
    sql["category_profit_margin"] = query(f"""
SELECT p.category_name, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  {dbl("SUM(f.profit_usd)")} AS total_profit_usd,
  {pct("SUM(f.profit_usd)", "SUM(f.revenue_usd)")} AS profit_margin_pct
FROM fact_sales f {PRODUCT_JOIN}
GROUP BY p.category_name""")
    sql["revenue_by_customer_country"] = query(f"""
SELECT c.country, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  COUNT(DISTINCT f.order_number) AS total_orders,
  COUNT(DISTINCT f.customer_key) AS total_customers,
  {per("SUM(f.revenue_usd)", "COUNT(DISTINCT f.order_number)")} AS aov_usd,
  {pct("SUM(f.revenue_usd)", TOTAL)} AS pct_of_total_revenue,
  {int_("RANK() OVER (ORDER BY SUM(f.revenue_usd) DESC)")} AS revenue_rank
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.country""")
    sql["revenue_by_customer_state_top15"] = query(f"""
SELECT c.country, c.state, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  COUNT(DISTINCT f.order_number) AS total_orders,
  {per("SUM(f.revenue_usd)", "COUNT(DISTINCT f.order_number)")} AS aov_usd
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.country, c.state
ORDER BY SUM(f.revenue_usd) DESC, c.country, c.state LIMIT 15""")
    sql["revenue_by_channel"] = query(f"""
SELECT CASE WHEN s.is_online THEN 'Online' ELSE 'In-Store' END AS channel,
  {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  COUNT(DISTINCT f.order_number) AS total_orders,
  {big("SUM(f.quantity)")} AS total_units_sold,
  {per("SUM(f.revenue_usd)", "COUNT(DISTINCT f.order_number)")} AS aov_usd,
  {pct("SUM(f.revenue_usd)", TOTAL)} AS pct_of_total_revenue
FROM fact_sales f JOIN dim_store s ON f.store_key = s.store_key
GROUP BY 1""")
    sql["revenue_by_store_country"] = query(f"""
SELECT s.country, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd,
  COUNT(DISTINCT f.order_number) AS total_orders,
  COUNT(DISTINCT f.store_key) AS store_count,
  {per("SUM(f.revenue_usd)", "COUNT(DISTINCT f.store_key)")} AS avg_revenue_per_store_usd
FROM fact_sales f JOIN dim_store s ON f.store_key = s.store_key
GROUP BY s.country""")
    return sql


CUSTOMER_CTE = """
customer_orders AS (
  SELECT customer_key, COUNT(DISTINCT order_number) AS n, SUM(revenue_usd) AS r,
    MIN(order_date) AS first_date, MAX(order_date) AS last_date
  FROM fact_sales GROUP BY customer_key
)"""
TYPE = "CASE WHEN n = 1 THEN 'One-time (1 order)' ELSE 'Repeat (2+ orders)' END"
N_CUSTOMERS = "(SELECT COUNT(*) FROM customer_orders)"


def customer_oracles() -> dict[str, str]:
    sql = {}
    sql["customers_with_zero_orders"] = query(f"""
SELECT m AS total_customers_in_master_data, b AS customers_with_at_least_one_order,
  m - b AS customers_never_ordered, {pct("m - b", "m")} AS pct_never_ordered
FROM (SELECT (SELECT COUNT(*) FROM dim_customer) AS m,
  (SELECT COUNT(DISTINCT customer_key) FROM fact_sales) AS b) AS t""")
    sql["repeat_vs_onetime_customers"] = query(
        f"""
SELECT {TYPE} AS customer_type, COUNT(*) AS num_customers,
  {pct("COUNT(*)", N_CUSTOMERS)} AS pct_of_customers
FROM customer_orders GROUP BY 1""",
        CUSTOMER_CTE,
    )
    sql["revenue_contribution_repeat_vs_onetime"] = query(
        f"""
SELECT {TYPE} AS customer_type, COUNT(*) AS num_customers,
  {dbl("SUM(r)")} AS total_revenue_usd, {pct("SUM(r)", TOTAL)} AS pct_of_total_revenue,
  {per("SUM(r)", "COUNT(r)")} AS avg_revenue_per_customer_usd
FROM customer_orders GROUP BY 1""",
        CUSTOMER_CTE,
    )
    sql["purchase_frequency_distribution"] = query(
        f"""
SELECT n AS orders_placed, COUNT(*) AS num_customers,
  {pct("COUNT(*)", N_CUSTOMERS)} AS pct_of_customers
FROM customer_orders GROUP BY 1""",
        CUSTOMER_CTE,
    )
    sql["top_20_customers_by_revenue"] = query(
        f"""
SELECT c.customer_key, c.name, c.country, n AS total_orders, {dbl("r")} AS total_revenue_usd,
  {int_("RANK() OVER (ORDER BY r DESC)")} AS revenue_rank
FROM customer_orders o JOIN dim_customer c ON o.customer_key = c.customer_key
ORDER BY r DESC, c.customer_key LIMIT 20""",
        CUSTOMER_CTE,
    )
    sql["revenue_concentration_deciles"] = query(
        f"""
SELECT decile, COUNT(*) AS num_customers, {dbl("SUM(r)")} AS decile_revenue_usd,
  {pct("SUM(r)", "(SELECT SUM(r) FROM customer_orders)")} AS pct_of_total_revenue,
  {pct("SUM(SUM(r)) OVER (ORDER BY decile)", "(SELECT SUM(r) FROM customer_orders)")}
    AS cumulative_pct_of_revenue
FROM (SELECT {int_("NTILE(10) OVER (ORDER BY r DESC, customer_key)")} AS decile, r
  FROM customer_orders) AS d
GROUP BY decile""",
        CUSTOMER_CTE,
    )
    sql["new_customers_per_year"] = query(
        f"""
SELECT year, COUNT(*) AS new_customers, {COMPLETENESS}
FROM (SELECT {int_("year(first_date)")} AS year FROM customer_orders) AS t
GROUP BY year""",
        CUSTOMER_CTE,
    )
    sql["avg_spend_and_frequency_by_country"] = query(
        f"""
SELECT c.country, COUNT(*) AS num_customers,
  {per("SUM(n)", "COUNT(*)")} AS avg_orders_per_customer,
  {per("SUM(r)", "COUNT(r)")} AS avg_revenue_per_customer_usd,
  {dbl("SUM(r)")} AS total_revenue_usd, {pct("SUM(r)", TOTAL)} AS pct_of_total_revenue
FROM customer_orders o JOIN dim_customer c ON o.customer_key = c.customer_key
GROUP BY c.country""",
        CUSTOMER_CTE,
    )
    sql["customer_lifespan_summary"] = query(
        f"""
SELECT CASE WHEN n = 1 THEN 'Single order (no lifespan)'
    WHEN days = 0 THEN 'Multiple orders, same day'
    WHEN days <= 30 THEN '2+ orders within 30 days'
    WHEN days <= 180 THEN '2+ orders, 31-180 days apart'
    WHEN days <= 365 THEN '2+ orders, 181-365 days apart'
    ELSE '2+ orders, over 1 year apart' END AS lifespan_bucket,
  COUNT(*) AS num_customers, {pct("COUNT(*)", N_CUSTOMERS)} AS pct_of_customers
FROM (SELECT n, last_date - first_date AS days FROM customer_orders) AS t
GROUP BY 1""",
        CUSTOMER_CTE,
    )
    return sql


__all__ = ["CUSTOMER_CTE", "customer_oracles", "rnd", "sales_oracles"]
