"""Check SQL for segmentation, cohorts, statistics, measures and dashboards."""

from __future__ import annotations

from basketlens.oracles.sales_sql import CUSTOMER_CTE, TOTAL
from basketlens.oracles.star_sql import big, dbl, int_, pct, per, query, rnd


def _even(expr: str) -> str:
    return f"round_even({expr}, 2)"


# -- RFM -----------------------------------------------------------------------

BASE_CTE = f"""{CUSTOMER_CTE},
base AS (
  SELECT customer_key, last_date AS last_order_date,
    {int_("(SELECT MAX(order_date) FROM fact_sales) + 1 - last_date")} AS recency_days,
    n AS frequency, {big("r * 100")} AS monetary_cents
  FROM customer_orders
)"""


def _bins(value: str) -> str:
    tests = [
        f"CAST({dbl(value)} > (SELECT quantile_cont({dbl(value)}, {p}) FROM base) AS INTEGER)"
        for p in (0.2, 0.4, 0.6, 0.8)
    ]
    return "(1 + " + " + ".join(tests) + ")"


# Segment names.
GRID = {
    5: ["New Customers", "Potential Loyalists", "Potential Loyalists", "Loyal Customers",
        "Champions"],
    4: ["New Customers", "Potential Loyalists", "Loyal Customers", "Loyal Customers", "Champions"],
    3: ["Promising", "Need Attention", "Need Attention", "Loyal Customers", "Loyal Customers"],
    2: ["About To Sleep", "About To Sleep", "At Risk", "At Risk", "Can''t Lose Them"],
    1: ["Lost", "Lost", "At Risk", "Can''t Lose Them", "Can''t Lose Them"],
}
SEGMENT = "CASE {} END".format(
    " ".join(
        f"WHEN r_score = {r} AND fm_score = {i + 1} THEN '{name}'"
        for r, row in GRID.items()
        for i, name in enumerate(row)
    )
)
RFM_CTE = f"""{BASE_CTE},
raw_scores AS (
  SELECT base.*, 6 - {_bins("recency_days")} AS r_score, {_bins("monetary_cents")} AS m_score,
    ROW_NUMBER() OVER (ORDER BY frequency, customer_key) - 1 AS i, COUNT(*) OVER () AS t
  FROM base
),
scores AS (
  SELECT customer_key, last_order_date, recency_days, frequency, monetary_cents,
    {int_("r_score")} AS r_score, f_score, {int_("m_score")} AS m_score,
    {int_("round_even((f_score + m_score) / 2.0, 0)")} AS fm_score,
    CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR)
      AS rfm_score_label
  FROM (SELECT *, {int_("1 + (SELECT COUNT(*) FROM (VALUES (1), (2), (3), (4)) AS g(k) "
                        "WHERE 5 * i > (t - 1) * k)")} AS f_score FROM raw_scores) AS s
),
segments AS (SELECT *, {SEGMENT} AS segment FROM scores)"""
N = "(SELECT COUNT(*) FROM segments)"
SUMMARY = f"""
SELECT segment, COUNT(*) AS num_customers,
  {dbl("SUM(monetary_cents)")} / 100 AS total_revenue_usd,
  {rnd("SUM(monetary_cents) / 100.0 / COUNT(*)")} AS avg_monetary_usd,
  {per("SUM(frequency)", "COUNT(*)")} AS avg_frequency,
  {per("SUM(recency_days)", "COUNT(*)")} AS avg_recency_days,
  {_even(f"CAST(100 AS DOUBLE) * COUNT(*) / {N}")} AS pct_of_customers,
  {_even("CAST(100 AS DOUBLE) * CAST(SUM(monetary_cents) AS DOUBLE) / CAST((SELECT SUM(monetary_cents) FROM segments) AS DOUBLE)")} AS pct_of_revenue
FROM segments GROUP BY segment"""


def rfm_oracles() -> dict[str, str]:
    return {
        "rfm_base": query("SELECT * FROM base", BASE_CTE),
        "rfm_scores": query("SELECT * FROM scores", RFM_CTE),
        "rfm_segments": query("SELECT * FROM segments", RFM_CTE),
        "rfm_segment_summary": query(SUMMARY, RFM_CTE),
        "rfm_segment_last_order_year": query(
            f"""
SELECT segment, {int_("year(last_order_date)")} AS year, COUNT(*) AS num_customers,
  {pct("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY segment)")} AS pct_of_segment
FROM segments GROUP BY 1, 2""",
            RFM_CTE,
        ),
        **{
            f"rfm_segment_by_{name}": query(
                f"""
SELECT segment, c.{source} AS {column}, COUNT(*) AS num_customers,
  {dbl("SUM(monetary_cents)")} / 100 AS total_revenue_usd,
  {pct("COUNT(*)", "SUM(COUNT(*)) OVER (PARTITION BY segment)")} AS pct_of_segment_customers,
  {pct("SUM(monetary_cents)", "SUM(SUM(monetary_cents)) OVER (PARTITION BY segment)")}
    AS pct_of_segment_revenue
FROM segments s LEFT JOIN dim_customer c ON c.customer_key = s.customer_key GROUP BY 1, 2""",
                RFM_CTE,
            )
            for name, source, column in [
                ("country", "country", "customer_country"), ("continent", "continent", "continent"),
            ]
        },
        "segment_filtered": query(
            f"SELECT * FROM ({SUMMARY}) AS s "
            "WHERE segment IN ('At Risk', 'Can''t Lose Them', 'Lost')",
            RFM_CTE,
        ),
        "dashboard_implicit_totals": query(
            f"""
SELECT {rnd("SUM(recency_days) / COUNT(*)", 6)} AS avg_recency_days,
  {rnd("SUM(frequency) / COUNT(*)", 6)} AS avg_frequency,
  {dbl("SUM(monetary_cents)")} / 100 AS sum_monetary_usd,
  (SELECT SUM(square_meters) FROM dim_store) AS sum_square_meters
FROM base""",
            BASE_CTE,
        ),
    }


# -- cohorts -------------------------------------------------------------------

COHORT_CTE = """
first_month AS (
  SELECT customer_key, MIN(date_trunc('month', order_date)) AS cohort FROM fact_sales GROUP BY 1
),
assigned AS (
  SELECT DISTINCT f.customer_key, f.order_number, f.order_date,
    CAST(date_trunc('month', f.order_date) AS DATE) AS order_month,
    CAST(m.cohort AS DATE) AS cohort_month,
    CAST(datediff('month', m.cohort, date_trunc('month', f.order_date)) AS INTEGER) AS period_number
  FROM fact_sales f JOIN first_month m ON f.customer_key = m.customer_key
),
active AS (
  SELECT cohort_month, period_number, COUNT(DISTINCT customer_key) AS active
  FROM assigned GROUP BY 1, 2
),
cohort_sizes AS (
  SELECT cohort_month, active AS cohort_size FROM active WHERE period_number = 0
),
grid AS (
  SELECT s.cohort_month, s.cohort_size, CAST(p.k AS INTEGER) AS period_number,
    COALESCE(a.active, 0) AS active_customers,
    CAST(100 AS DOUBLE) * COALESCE(a.active, 0) / s.cohort_size AS pct
  FROM cohort_sizes s
  CROSS JOIN (SELECT unnest(generate_series(0, (SELECT MAX(period_number) FROM active))) AS k) AS p
  LEFT JOIN active a ON a.cohort_month = s.cohort_month AND a.period_number = p.k
  WHERE p.k <= datediff('month', s.cohort_month, (SELECT MAX(order_month) FROM assigned))
)"""

# The wide tables list their columns; the check data reaches period 78.
DEEPEST = 78
BEST = f"""arg_max(cohort_month, (pct, -datediff('month', DATE '1970-01-01', cohort_month))) AS best_cohort,
  {rnd("MAX(pct)", 6)} AS best_pct,
  arg_min(cohort_month, (pct, datediff('month', DATE '1970-01-01', cohort_month))) AS worst_cohort,
  {rnd("MIN(pct)", 6)} AS worst_pct"""


def _wide(cell: str) -> str:
    cols = ",\n  ".join(
        f"MAX(CASE WHEN period_number = {k} THEN {cell} END) AS period_{k}"
        for k in range(DEEPEST + 1)
    )
    return f"SELECT cohort_month,\n  {cols}\nFROM grid GROUP BY 1"


def cohort_oracles() -> dict[str, str]:
    avg = f"""SELECT period_number, {rnd("AVG(pct)", 6)} AS avg_retention_pct,
  COUNT(*) AS cohorts_averaged FROM grid"""
    bodies = {
        "cohort_assign": "SELECT * FROM assigned",
        "cohort_active": "SELECT * FROM active",
        "cohort_grid": "SELECT cohort_month, cohort_size, period_number, active_customers FROM grid",
        "cohort_retention_pct": f"""SELECT cohort_month, cohort_size, period_number,
  active_customers, {_even("pct")} AS retention_pct FROM grid""",
        "cohort_matrix": _wide("active_customers"),
        "cohort_pct_matrix": _wide(_even("pct")),
        "cohort_avg_retention": f"{avg} GROUP BY 1",
        "cohort_curve": f"{avg} WHERE period_number > 0 GROUP BY 1",
        "cohort_month1": f"""SELECT cohort_month, cohort_size, {rnd("pct", 6)} AS month1_pct
FROM grid WHERE period_number = 1""",
        "cohort_month1_stats": f"""SELECT COUNT(*) AS cohorts, {rnd("AVG(pct)", 6)} AS mean_pct,
  {rnd("stddev_samp(pct)", 6)} AS std_pct, {BEST} FROM grid WHERE period_number = 1""",
        "cohort_month1_large": f"""SELECT COUNT(*) AS cohorts, {BEST}
FROM grid WHERE period_number = 1 AND cohort_size >= 100""",
        "cohort_month1_trend": f"""
SELECT n AS cohorts, {rnd("c", 6)} AS trend_correlation,
  CASE WHEN abs(c) < 0.3 THEN 'weak/no trend' WHEN c > 0 THEN 'improving over time'
    WHEN c < 0 THEN 'declining over time' END AS trend
FROM (SELECT COUNT(*) AS n, CASE WHEN COUNT(*) > 2 THEN corr(x, pct) END AS c
  FROM (SELECT pct, ROW_NUMBER() OVER (ORDER BY cohort_month) - 1 AS x
    FROM grid WHERE period_number = 1) AS s) AS t""",
        "cohort_size_range": """SELECT COUNT(*) AS cohorts, MIN(cohort_month) AS first_cohort,
  MAX(cohort_month) AS last_cohort, MIN(cohort_size) AS min_size, MAX(cohort_size) AS max_size
FROM cohort_sizes""",
        "cohort_zoom_12": f"""SELECT cohort_month, period_number, {_even("pct")} AS retention_pct,
  {rnd("(SELECT MAX(pct) FROM grid WHERE period_number >= 1)", 6)} AS color_ceiling_pct
FROM grid WHERE period_number <= 12""",
        "m_month1_retention": f"""SELECT {rnd("AVG(pct)", 6)} AS month1_retention_pct,
  COUNT(*) AS cohorts_averaged FROM grid WHERE period_number = 1""",
    }
    return {k: query(v, COHORT_CTE) for k, v in bodies.items()}


# -- statistics ----------------------------------------------------------------

ORDER_CTE = """
x AS (
  SELECT order_number, SUM(revenue_usd) AS v, COUNT(*) AS lines FROM fact_sales GROUP BY 1
)"""
SPEND_CTE = "x AS (SELECT customer_key, SUM(revenue_usd) AS v FROM fact_sales GROUP BY 1)"
LINE_CTE = "x AS (SELECT revenue_usd AS v FROM fact_sales)"
AGE_CTE = """
x AS (
  SELECT (SELECT MAX(order_date) FROM fact_sales) - birthday AS v
  FROM dim_customer WHERE customer_key IN (SELECT customer_key FROM fact_sales)
)"""


def _skew(v: str) -> str:
    mean = f"(SELECT AVG({dbl('v')}) FROM x)"
    d = f"({dbl(v)} - {mean})"
    return f"AVG({d} * {d} * {d}) / pow(AVG({d} * {d}), 1.5)"


def _stats(shape: bool) -> str:
    label = (
        ", CASE WHEN skewness > 0.5 THEN 'right-skewed (long tail of high-value orders)' "
        "ELSE 'roughly symmetric' END AS shape"
        if shape
        else ""
    )
    return f"""
SELECT *{label} FROM (
  SELECT COUNT(*) AS count, {rnd("SUM(v) / COUNT(*)", 4)} AS mean_usd,
    {rnd(f"quantile_cont({dbl('v')}, 0.5)", 4)} AS median_usd,
    {rnd(f"stddev_samp({dbl('v')})", 4)} AS std_usd, {dbl("MIN(v)")} AS min_usd,
    {dbl("MAX(v)")} AS max_usd, {rnd(_skew("v"), 6)} AS skewness
  FROM x) AS s"""


def _q(p: float) -> str:
    return f"quantile_cont({dbl('v')}, {p})"


FENCES = f"""
q AS (SELECT {_q(0.25)} AS q1, {_q(0.5)} AS q2, {_q(0.75)} AS q3 FROM x),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""
BOX = f"""
SELECT {rnd("MAX(q1)", 4)} AS q1_usd, {rnd("MAX(q2)", 4)} AS median_usd,
  {rnd("MAX(q3)", 4)} AS q3_usd,
  {dbl("MIN(v) FILTER (WHERE v >= lo)")} AS whisker_low_usd,
  {dbl("MAX(v) FILTER (WHERE v <= hi)")} AS whisker_high_usd,
  COUNT(*) AS count, COUNT(*) FILTER (WHERE v < lo) AS low_count,
  COUNT(*) FILTER (WHERE v > hi) AS high_count
FROM x, f"""


def _histogram(bins: int, scale: float, digits: int) -> str:
    """Integer bins: cents for money, days for ages."""
    unit = "100" if scale == 100 else "1"
    return f"""
SELECT {int_("g.k")} AS bin,
  {rnd(f"({dbl('a')} + g.k * ({dbl('b - a')} / {bins})) / {scale}", digits)} AS bin_low,
  {rnd(f"({dbl('a')} + (g.k + 1) * ({dbl('b - a')} / {bins})) / {scale}", digits)} AS bin_high,
  COALESCE(h.n, 0) AS n
FROM (SELECT {big(f"MIN(v) * {unit}")} AS a, {big(f"MAX(v) * {unit}")} AS b FROM x) AS s
CROSS JOIN (SELECT unnest(generate_series(0, {bins - 1})) AS k) AS g
LEFT JOIN (
  SELECT least(({big(f"v * {unit}")} - a) * {bins} // greatest(b - a, 1), {bins - 1}) AS k,
    COUNT(*) AS n
  FROM x, (SELECT {big(f"MIN(v) * {unit}")} AS a, {big(f"MAX(v) * {unit}")} AS b FROM x) AS t
  GROUP BY 1) AS h ON h.k = g.k"""


def _log_histogram(bins: int) -> str:
    span = (
        f"(SELECT MIN(y) AS a, MAX(y) AS b, (MAX(y) - MIN(y)) / {bins} AS w FROM "
        f"(SELECT log10({dbl('v')}) AS y FROM x WHERE v > 0) AS l)"
    )
    return f"""
SELECT {int_("g.k")} AS bin, {rnd("a + g.k * w", 6)} AS bin_low,
  {rnd("a + (g.k + 1) * w", 6)} AS bin_high, COALESCE(h.n, 0) AS n
FROM {span} AS s
CROSS JOIN (SELECT unnest(generate_series(0, {bins - 1})) AS k) AS g
LEFT JOIN (
  SELECT least({big("floor((y - a) / w)")}, {bins - 1}) AS k, COUNT(*) AS n
  FROM (SELECT log10({dbl("v")}) AS y FROM x WHERE v > 0) AS l, {span} AS t
  GROUP BY 1) AS h ON h.k = g.k"""


def eda_oracles() -> dict[str, str]:
    sql = {}
    sql["eda_order_revenue_stats"] = query(_stats(True), ORDER_CTE)
    sql["eda_order_outliers"] = query(
        f"""
SELECT {rnd("MAX(hi)", 4)} AS upper_fence_usd, COUNT(*) FILTER (WHERE v > hi) AS outlier_orders,
  {pct("COUNT(*) FILTER (WHERE v > hi)", "COUNT(*)")} AS pct_of_orders,
  {dbl("SUM(v) FILTER (WHERE v > hi)")} AS outlier_revenue_usd,
  {pct("SUM(v) FILTER (WHERE v > hi)", "SUM(v)")} AS pct_of_revenue
FROM x, f""",
        f"{ORDER_CTE},{FENCES}",
    )
    sql["eda_hist_order_revenue"] = query(_histogram(60, 100, 4), ORDER_CTE)
    sql["eda_order_box"] = query(BOX, f"{ORDER_CTE},{FENCES}")
    sql["eda_lines_per_order"] = query(
        f"""
SELECT {rnd("SUM(lines) / COUNT(*)", 6)} AS mean_lines,
  {dbl("quantile_cont(CAST(lines AS DOUBLE), 0.5)")} AS median_lines, MAX(lines) AS max_lines,
  (SELECT lines FROM x GROUP BY 1 ORDER BY COUNT(*) DESC, lines LIMIT 1) AS mode_lines
FROM x""",
        ORDER_CTE,
    )
    sql["eda_lines_per_order_dist"] = query(
        "SELECT lines, COUNT(*) AS orders FROM x GROUP BY 1", ORDER_CTE
    )
    sql["eda_customer_spend_stats"] = query(_stats(False), SPEND_CTE)
    linear, log = _histogram(60, 100, 4), _log_histogram(60)
    sql["eda_hist_customer_spend"] = query(
        f"SELECT 'linear' AS scale, * FROM ({linear}) AS a\n"
        f"UNION ALL SELECT 'log10' AS scale, * FROM ({log}) AS b",
        SPEND_CTE,
    )
    sql["eda_customer_age"] = query(
        f"""
SELECT COUNT(*) AS count, {rnd("SUM(v) / COUNT(*) / 365.25", 6)} AS mean_age,
  {rnd(f"{_q(0.5)} / 365.25", 6)} AS median_age,
  {rnd(f"stddev_samp({dbl('v')}) / 365.25", 6)} AS std_age,
  {rnd("MIN(v) / 365.25", 6)} AS min_age, {rnd("MAX(v) / 365.25", 6)} AS max_age
FROM x""",
        AGE_CTE,
    )
    sql["eda_hist_age"] = query(_histogram(40, 365.25, 6), AGE_CTE)
    sql["eda_country_revenue"] = query(f"""
SELECT c.country, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY 1""")
    scatter = """
x AS (
  SELECT f.product_key, p.category_name, SUM(f.quantity) AS q, SUM(f.revenue_usd) AS r
  FROM fact_sales f JOIN flat p ON f.product_key = p.product_key GROUP BY 1, 2
)"""
    sql["eda_product_qty_revenue"] = query(
        f"""SELECT product_key, category_name, {big("q")} AS total_quantity,
  {dbl("r")} AS total_revenue_usd FROM x""",
        scatter,
    )
    sql["eda_product_qty_revenue_corr"] = query(
        f"""SELECT COUNT(*) AS products, {rnd(f"corr({dbl('q')}, {dbl('r')})", 6)} AS pearson_r
FROM x""",
        scatter,
    )
    sql["eda_category_line_box"] = query(
        f"""
SELECT x.category_name, {rnd("MAX(q1)", 4)} AS q1_usd, {rnd("MAX(q2)", 4)} AS median_usd,
  {rnd("MAX(q3)", 4)} AS q3_usd,
  {dbl("MIN(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))")} AS whisker_low_usd,
  {dbl("MAX(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))")} AS whisker_high_usd,
  COUNT(*) AS count, COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1)) AS low_count,
  COUNT(*) FILTER (WHERE v > q3 + 1.5 * (q3 - q1)) AS high_count
FROM x JOIN (SELECT category_name, {_q(0.25)} AS q1, {_q(0.5)} AS q2, {_q(0.75)} AS q3
  FROM x GROUP BY 1) AS q ON x.category_name = q.category_name
GROUP BY 1""",
        """
x AS (
  SELECT p.category_name, f.revenue_usd AS v
  FROM fact_sales f JOIN flat p ON f.product_key = p.product_key
)""",
    )
    sql["eda_line_outliers"] = query(
        f"""
SELECT {rnd("MAX(hi)", 4)} AS upper_fence_usd, COUNT(*) FILTER (WHERE v > hi) AS outlier_lines,
  {pct("COUNT(*) FILTER (WHERE v > hi)", "COUNT(*)")} AS pct_of_lines,
  {dbl("MAX(v)")} AS max_line_usd,
  (SELECT quantity FROM top) AS max_line_quantity,
  (SELECT product_name FROM top) AS max_line_product
FROM x, f""",
        f"""{LINE_CTE},{FENCES},
top AS (
  SELECT f.quantity, p.product_name FROM fact_sales f
  LEFT JOIN dim_product p ON f.product_key = p.product_key
  ORDER BY f.revenue_usd DESC, f.order_number, f.line_item, f.product_key LIMIT 1
)""",
    )
    monthly = """
m AS (
  SELECT strftime(order_date, '%Y-%m') AS year_month, SUM(revenue_usd) AS r
  FROM fact_sales GROUP BY 1
)"""
    sql["eda_monthly_range"] = query(
        f"""
SELECT {dbl("MIN(r)")} AS min_revenue_usd, {dbl("MAX(r)")} AS max_revenue_usd,
  (SELECT year_month FROM m ORDER BY r DESC, year_month LIMIT 1) AS best_month,
  (SELECT year_month FROM m ORDER BY r, year_month LIMIT 1) AS worst_month
FROM m""",
        monthly,
    )
    sql["eda_seasonality"] = query(
        f"""
SELECT {int_("month(order_date)")} AS month,
  {rnd(f"{dbl('SUM(revenue_usd)')} / (SELECT COUNT(DISTINCT year(order_date)) FROM full_years)", 4)}
    AS avg_revenue_usd
FROM full_years GROUP BY 1""",
        """
full_years AS (
  SELECT * FROM fact_sales
  WHERE year(order_date) < (SELECT MAX(year(order_date)) FROM fact_sales)
)""",
    )
    sql["eda_weekday_revenue"] = query(f"""
SELECT {int_("d.k")} AS weekday, d.name AS day_name, {dbl("SUM(f.revenue_usd)")} AS total_revenue_usd
FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
  (5, 'Saturday'), (6, 'Sunday')) AS d(k, name)
LEFT JOIN fact_sales f ON isodow(f.order_date) - 1 = d.k
GROUP BY 1, 2""")
    return sql


# -- measures and dashboards -----------------------------------------------------

WIDE_CTE = """
wide AS (
  SELECT f.*, CAST(year(f.order_date) AS INTEGER) AS year,
    CAST(quarter(f.order_date) AS INTEGER) AS quarter,
    CAST(month(f.order_date) AS INTEGER) AS month,
    c.country AS customer_country, c.state AS customer_state, c.continent,
    p.category_name, p.subcategory_key,
    CASE WHEN s.is_online THEN 'Online' ELSE 'In-Store' END AS channel
  FROM fact_sales f
  JOIN dim_customer c ON f.customer_key = c.customer_key
  JOIN flat p ON f.product_key = p.product_key
  JOIN dim_store s ON f.store_key = s.store_key
),
history AS (
  SELECT customer_key, COUNT(DISTINCT order_number) AS n, MIN(order_date) AS first_date
  FROM fact_sales GROUP BY 1
)"""
LAST = "(SELECT MAX(order_date) FROM fact_sales)"


def _in_context(dims: str, where: str = "TRUE") -> str:
    """Customers counted per context: once, ever repeat, repeat here, new here."""
    return f"""
SELECT {dims}, COUNT(*) AS c, COUNT(*) FILTER (WHERE n >= 2) AS ever,
  COUNT(*) FILTER (WHERE n_here >= 2) AS again,
  COUNT(*) FILTER (WHERE first_here = first_date) AS fresh
FROM (SELECT {dims}, customer_key, COUNT(DISTINCT order_number) AS n_here,
    MIN(order_date) AS first_here
  FROM wide WHERE {where} GROUP BY ALL) AS u
JOIN history USING (customer_key)
GROUP BY {dims}"""


def measure_oracles() -> dict[str, str]:
    r, o = "SUM(revenue_usd)", "COUNT(DISTINCT order_number)"
    c = "COUNT(DISTINCT customer_key)"
    bodies = {
        "m_total_revenue": f"SELECT year, category_name, {dbl(r)} AS total_revenue "
        "FROM wide GROUP BY 1, 2",
        "m_total_orders": f"SELECT year, channel, {o} AS total_orders FROM wide GROUP BY 1, 2",
        "m_total_customers": f"SELECT customer_country, {c} AS total_customers "
        "FROM wide GROUP BY 1",
        "m_units_sold": f"SELECT year, quarter, category_name, {big('SUM(quantity)')} "
        "AS units_sold FROM wide GROUP BY 1, 2, 3",
        "m_average_order_value": f"""
SELECT year, channel, {per("SUM(v)", "COUNT(*)")} AS average_order_value,
  {rnd(_q(0.5), 4)} AS median_order_value
FROM (SELECT year, channel, order_number, {r} AS v FROM wide GROUP BY 1, 2, 3) AS x
GROUP BY 1, 2""",
        "m_revenue_per_customer": f"SELECT continent, {per(r, c)} AS revenue_per_customer "
        "FROM wide GROUP BY 1",
        "m_historical_clv": f"SELECT customer_state, {per(r, c)} AS historical_clv "
        "FROM wide GROUP BY 1",
        "m_repeat_customers": f"SELECT year, ever AS repeat_customers, "
        f"again AS repeat_customers_in_context FROM ({_in_context('year')}) AS t",
        "m_repeat_purchase_rate": f"SELECT customer_country, {pct('ever', 'c')} "
        f"AS repeat_purchase_rate_pct FROM ({_in_context('customer_country')}) AS t",
        "m_new_customers": f"SELECT year, customer_country, fresh AS new_customers "
        f"FROM ({_in_context('year, customer_country')}) AS t",
        "new_vs_returning_by_year": f"SELECT year, fresh AS new_customers, "
        f"c - fresh AS returning_customers, c AS total_customers FROM ({_in_context('year')}) AS t",
        "m_revenue_yoy": f"""
SELECT year, month, {pct("COALESCE(cur, 0) - prior", "prior")} AS revenue_yoy_growth_pct
FROM (SELECT {int_("year(d)")} AS year, {int_("month(d)")} AS month, SUM(cur) AS cur,
    SUM(prior) AS prior
  FROM (SELECT order_date AS d, revenue_usd AS cur, NULL AS prior FROM fact_sales
    UNION ALL
    SELECT CAST(order_date + INTERVAL 12 MONTH AS DATE), NULL, revenue_usd FROM fact_sales) AS u
  WHERE d <= {LAST}
  GROUP BY 1, 2) AS t""",
        "m_revenue_yoy_to_calendar_end": f"""
SELECT year, {pct("COALESCE(cur, 0) - prior", "prior")} AS revenue_yoy_growth_pct,
  last_day <= {LAST} AS yoy_period_complete
FROM (SELECT {int_("year(d)")} AS year, SUM(cur) AS cur, SUM(prior) AS prior, MAX(d) AS last_day
  FROM (SELECT order_date AS d, revenue_usd AS cur, NULL AS prior FROM fact_sales
    UNION ALL
    SELECT CAST(order_date + INTERVAL 12 MONTH AS DATE), NULL, revenue_usd FROM fact_sales) AS u
  WHERE d <= DATE '2001-12-31'
  GROUP BY 1) AS t""",
        "weekday_channel_orders": f"SELECT {int_('isodow(order_date) - 1')} AS weekday, "
        f"dayname(order_date) AS day_name, channel, {o} AS orders FROM wide GROUP BY 1, 2, 3",
        "product_margin_tiers": f"SELECT {pct('unit_price_usd - unit_cost_usd', 'unit_price_usd')} "
        "AS margin_pct, COUNT(*) AS products FROM dim_product GROUP BY 1",
        "drill_category": f"""
SELECT category_name, subcategory_key, product_key,
  {int_("GROUPING(category_name, subcategory_key, product_key)")} AS level_mask,
  {dbl(r)} AS revenue_usd
FROM wide GROUP BY ROLLUP (category_name, subcategory_key, product_key)""",
        "drill_date": f"""
SELECT year, quarter, month, {int_("GROUPING(year, quarter, month)")} AS level_mask,
  {dbl(r)} AS revenue_usd
FROM wide GROUP BY ROLLUP (year, quarter, month)""",
        "trend_tooltip": f"SELECT strftime(order_date, '%Y-%m') AS year_month, {dbl(r)} "
        f"AS revenue_usd, {o} AS orders, {per(r, o)} AS aov_usd FROM wide GROUP BY 1",
    }
    slicer = "category_name IN ('ECONOMY', 'PROMO') AND continent = 'EUROPE'"
    bodies["sliced_kpis"] = f"""
SELECT year, channel, {dbl("r")} AS total_revenue, o AS total_orders, c AS total_customers,
  {big("q")} AS units_sold, {per("r", "o")} AS average_order_value,
  {per("r", "c")} AS revenue_per_customer, {per("r", "c")} AS historical_clv,
  {pct("COALESCE(r, 0) - prior", "prior")} AS revenue_yoy_growth_pct,
  ever AS repeat_customers, {pct("ever", "c")} AS repeat_purchase_rate_pct
FROM (SELECT year, channel, {r} AS r, {o} AS o, SUM(quantity) AS q
  FROM wide WHERE {slicer} GROUP BY 1, 2) AS a
FULL JOIN ({_in_context("year, channel", slicer)}) AS b USING (year, channel)
FULL JOIN (SELECT {int_("year(order_date + INTERVAL 12 MONTH)")} AS year, channel, {r} AS prior
  FROM wide WHERE {slicer} AND order_date + INTERVAL 12 MONTH <= {LAST} GROUP BY 1, 2) AS p
  USING (year, channel)"""
    sql = {k: query(v, WIDE_CTE) for k, v in bodies.items()}
    sql["m_revenue_by_segment"] = query(
        f"""
SELECT s.segment, year, {dbl(r)} AS total_revenue, {o} AS total_orders,
  COUNT(DISTINCT w.customer_key) AS total_customers,
  COUNT(DISTINCT w.customer_key) FILTER (WHERE s.frequency >= 2) AS repeat_customers
FROM wide w JOIN segments s ON s.customer_key = w.customer_key
WHERE s.segment IN ('Champions', 'Loyal Customers', 'At Risk', 'Lost') GROUP BY 1, 2""",
        f"{WIDE_CTE},\n{RFM_CTE}",
    )
    deciles = f"""{CUSTOMER_CTE},
d AS (
  SELECT r, NTILE(10) OVER (ORDER BY r DESC, customer_key) AS decile FROM customer_orders
)"""
    low = "SUM(r) FILTER (WHERE decile >= 6)"
    sql["bottom_half_revenue_share"] = query(
        f"""
SELECT COUNT(*) FILTER (WHERE decile >= 6) AS customers, {dbl(low)} AS revenue_usd,
  {pct(low, "SUM(r)")} AS pct_of_total_revenue
FROM d""",
        deciles,
    )
    sql["top_customer_share"] = query(
        f"""
SELECT customer_key, {dbl("r")} AS revenue_usd,
  {rnd(f"CAST(100 AS DOUBLE) * {dbl('r')} / {dbl(TOTAL)}", 4)} AS pct_of_total_revenue
FROM customer_orders ORDER BY r DESC, customer_key LIMIT 1""",
        CUSTOMER_CTE,
    )
    return sql
