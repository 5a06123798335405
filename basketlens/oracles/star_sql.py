"""Check SQL for the star schema: one WITH list over the source tables.

Unused entries cost nothing, so every check query starts with the same list.
"""

from __future__ import annotations

STAR_CTES = """
fact_sales AS (
  SELECT *,
    CAST(quantity * unit_price_usd AS DECIMAL(18,2)) AS revenue_usd,
    CAST(quantity * unit_cost_usd AS DECIMAL(18,2)) AS cost_usd,
    CAST(quantity * (unit_price_usd - unit_cost_usd) AS DECIMAL(18,2)) AS profit_usd
  FROM (
    SELECT l_orderkey AS order_number,
      CAST(l_linenumber AS BIGINT) AS line_item,
      CAST(o_orderdate AS DATE) AS order_date,
      CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS delivery_date,
      (l_linestatus = 'F') AS is_delivered,
      o_custkey AS customer_key,
      l_suppkey AS store_key,
      l_partkey AS product_key,
      CAST(l_quantity AS INTEGER) AS quantity,
      CASE o_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'AUD'
        WHEN 3 THEN 'EUR' ELSE 'GBP' END AS currency_code,
      CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price_usd,
      CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2))
        * CAST((40 + p_size % 30) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(4,2)), 2)
        AS DECIMAL(10,2)) AS unit_cost_usd
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
  ) AS line
),
dim_category AS (
  SELECT DISTINCT p_type AS category_key, p_type AS category_name FROM part
),
dim_subcategory AS (
  SELECT DISTINCT p_type || '/' || p_brand AS subcategory_key,
    p_brand AS subcategory_name, p_type AS category_key
  FROM part
),
dim_product AS (
  SELECT p_partkey AS product_key, p_name AS product_name, p_brand AS brand,
    split_part(p_name, ' ', 1) AS color,
    CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2))
      * CAST((40 + p_size % 30) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(4,2)), 2)
      AS DECIMAL(10,2)) AS unit_cost_usd,
    CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price_usd,
    p_type || '/' || p_brand AS subcategory_key
  FROM part
),
dim_customer AS (
  SELECT c_custkey AS customer_key,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    c_name AS name, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state_code,
    c_mktsegment AS state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
    n_name AS country, r_name AS continent,
    DATE '1935-02-03' + CAST((c_custkey * 37) % 24000 AS INTEGER) AS birthday
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_store AS (
  SELECT s_suppkey AS store_key,
    CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE n_name END AS country,
    CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE n_name END AS state,
    CASE WHEN s_suppkey % 5 <> 0 THEN CAST(200 + s_suppkey % 1800 AS DOUBLE) END AS square_meters,
    DATE '2005-03-04' + CAST((s_suppkey * 53) % 5000 AS INTEGER) AS open_date,
    (s_suppkey % 5 = 0) AS is_online
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
dim_date AS (
  SELECT date_key,
    CAST(year(date_key) AS INTEGER) AS year, CAST(quarter(date_key) AS INTEGER) AS quarter,
    CAST(month(date_key) AS INTEGER) AS month, monthname(date_key) AS month_name,
    CAST(day(date_key) AS INTEGER) AS day,
    CAST(isodow(date_key) - 1 AS INTEGER) AS day_of_week, dayname(date_key) AS day_name,
    (isodow(date_key) >= 6) AS is_weekend
  FROM (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key
    FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM fact_sales) AS span
  ) AS days
),
exchange_rate AS (
  SELECT date_key AS rate_date, currency,
    CASE WHEN currency = 'USD' THEN CAST(base AS DECIMAL(12,6)) ELSE
      CAST(base + CAST(dayofyear(date_key) AS DECIMAL(5,0)) * CAST(0.0005 AS DECIMAL(6,4))
        AS DECIMAL(12,6)) END AS exchange
  FROM dim_date, (VALUES
    ('USD', CAST(1.0 AS DECIMAL(12,6))), ('CAD', CAST(1.25 AS DECIMAL(12,6))),
    ('AUD', CAST(1.35 AS DECIMAL(12,6))), ('EUR', CAST(0.85 AS DECIMAL(12,6))),
    ('GBP', CAST(0.72 AS DECIMAL(12,6)))) AS c(currency, base)
),
flat AS (
  SELECT p.product_key, p.product_name, p.brand, c.category_name, c.category_key,
    sc.subcategory_key, sc.subcategory_name
  FROM dim_product p
  JOIN dim_subcategory sc ON p.subcategory_key = sc.subcategory_key
  JOIN dim_category c ON sc.category_key = c.category_key
)"""


def query(body: str, ctes: str = "") -> str:
    """A check query: the star, extra WITH entries, then ``body``."""
    extra = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {STAR_CTES.strip()}{extra}\n{body.strip()}"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def rnd(expr: str, digits: int = 2) -> str:
    """Round halves away from zero on the decimal value of a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return rnd(f"CAST(100 AS DOUBLE) * {dbl(num)} / NULLIF({dbl(den)}, 0)")


def per(num: str, den: str) -> str:
    return rnd(f"{dbl(num)} / NULLIF({dbl(den)}, 0)")


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def int_(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"
