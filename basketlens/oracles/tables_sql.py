"""Check SQL for cleaning, star tables, quality checks and profiles."""

from __future__ import annotations

from basketlens.oracles.star_sql import big, dbl, int_, pct, query, rnd


def _date_text(col: str) -> str:
    return f"strftime({col}, '%-m/%-d/%Y')"


def _money_text(col: str) -> str:
    return f"format('${{:,.2f}} ', {dbl(col)})"


FACT_SELECT = f"""
SELECT order_number, line_item, order_date, delivery_date, is_delivered, customer_key,
  store_key, product_key, quantity, currency_code,
  {dbl("unit_price_usd")} AS unit_price_usd, {dbl("unit_cost_usd")} AS unit_cost_usd,
  {dbl("revenue_usd")} AS revenue_usd, {dbl("cost_usd")} AS cost_usd,
  {dbl("profit_usd")} AS profit_usd
FROM fact_sales"""
PRODUCT_SELECT = f"""
SELECT product_key, product_name, brand, color, {dbl("unit_cost_usd")} AS unit_cost_usd,
  {dbl("unit_price_usd")} AS unit_price_usd, subcategory_key
FROM dim_product"""


def cleaning_oracles() -> dict[str, str]:
    sql = {}
    sql["clean_parse_money"] = query(f"""
SELECT product_key, {_money_text("unit_price_usd")} AS price_text,
  {dbl("unit_price_usd")} AS unit_price_usd, {dbl("unit_cost_usd")} AS unit_cost_usd
FROM dim_product""")
    sql["clean_parse_dates"] = query(f"""
SELECT {_date_text("order_date")} AS date_text, order_date AS parsed_date, COUNT(*) AS n_rows
FROM fact_sales GROUP BY order_date""")
    sql["clean_customers"] = query("SELECT * FROM dim_customer")
    sql["clean_products"] = query(f"""
SELECT p.product_key, p.product_name, p.brand, color, {dbl("unit_cost_usd")} AS unit_cost_usd,
  {dbl("unit_price_usd")} AS unit_price_usd, p.subcategory_key, subcategory_name,
  category_key, category_name
FROM dim_product p JOIN flat f ON p.product_key = f.product_key""")
    sql["clean_store_channel"] = query("SELECT * FROM dim_store")
    sql["clean_exchange_rates"] = query(
        f"SELECT rate_date, currency, {dbl('exchange')} AS exchange FROM exchange_rate"
    )
    sql["clean_sales_enriched"] = query(FACT_SELECT)
    sql["dim_category"] = query("SELECT * FROM dim_category")
    sql["dim_subcategory"] = query("SELECT * FROM dim_subcategory")
    sql["dim_product"] = query(PRODUCT_SELECT)
    sql["dim_customer"] = query("SELECT * FROM dim_customer")
    sql["dim_store"] = query("SELECT * FROM dim_store")
    sql["dim_date"] = query("SELECT * FROM dim_date")
    sql["dim_date_fixed"] = query("""
SELECT d.date_key, d.month_name, d.day_name, d.is_weekend, d.year, d.quarter, d.month, d.day,
  d.day_of_week, COUNT(f.order_number) AS n_lines,
  (SELECT COUNT(*) FROM fact_sales WHERE order_date < DATE '1995-01-01') AS lines_before,
  (SELECT COUNT(*) FROM fact_sales WHERE order_date > DATE '2001-12-31') AS lines_after
FROM (SELECT date_key, monthname(date_key) AS month_name, dayname(date_key) AS day_name,
    (isodow(date_key) >= 6) AS is_weekend,
    CAST(year(date_key) AS INTEGER) AS year, CAST(quarter(date_key) AS INTEGER) AS quarter,
    CAST(month(date_key) AS INTEGER) AS month, CAST(day(date_key) AS INTEGER) AS day,
    CAST(isodow(date_key) - 1 AS INTEGER) AS day_of_week
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
    INTERVAL 1 DAY)) AS DATE) AS date_key) AS s) AS d
LEFT JOIN fact_sales f ON f.order_date = d.date_key
GROUP BY ALL""")
    sql["fact_sales_build"] = query(FACT_SELECT)
    sql["exchange_rate"] = query(
        f"SELECT rate_date, currency, {dbl('exchange')} AS exchange FROM exchange_rate"
    )
    sql["revenue_local_currency"] = query(f"""
SELECT f.currency_code, {int_("year(f.order_date)")} AS year,
  {dbl("SUM(f.revenue_usd)")} AS revenue_usd,
  {dbl("ROUND(SUM(CAST(f.revenue_usd * e.exchange AS DECIMAL(30,8))), 2)")} AS revenue_local,
  COUNT(*) - COUNT(e.exchange) AS lines_without_rate
FROM fact_sales f
LEFT JOIN exchange_rate e ON f.order_date = e.rate_date AND f.currency_code = e.currency
GROUP BY 1, 2""")
    return sql


def _check(name: str, found: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, {dbl(found)} AS observed, CAST(0 AS DOUBLE) AS threshold, "
        f"({found}) = 0 AS passed"
    )


def _orphans(child: str, parent: str, key: str, parent_key: str | None = None) -> str:
    pk = parent_key or key
    return (
        f"(SELECT COUNT(*) FROM {child} c LEFT JOIN {parent} p ON c.{key} = p.{pk} "
        f"WHERE p.{pk} IS NULL)"
    )


def _count(table: str, condition: str = "TRUE") -> str:
    return f"(SELECT COUNT(*) FROM {table} WHERE {condition})"


def _surplus(table: str, keys: str) -> str:
    return f"(SELECT COUNT(*) - COUNT(DISTINCT ({keys})) FROM {table})"


FK = {
    "fact_sales.customer_key": _orphans("fact_sales", "dim_customer", "customer_key"),
    "fact_sales.product_key": _orphans("fact_sales", "dim_product", "product_key"),
    "fact_sales.store_key": _orphans("fact_sales", "dim_store", "store_key"),
    "fact_sales.order_date": _orphans("fact_sales", "dim_date", "order_date", "date_key"),
    "dim_product.subcategory_key": _orphans("dim_product", "dim_subcategory", "subcategory_key"),
    "dim_subcategory.category_key": _orphans("dim_subcategory", "dim_category", "category_key"),
}
TOTAL = "(SELECT SUM(revenue_usd) FROM fact_sales)"


def quality_oracles() -> dict[str, str]:
    dup = _surplus("fact_sales", "order_number, line_item")
    composite = (
        "((SELECT COUNT(*) FROM fact_sales) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_number, "
        "line_item FROM fact_sales WHERE order_number IS NOT NULL AND line_item IS NOT NULL) AS k))"
    )
    one = {
        "dup_transaction_key": dup,
        "order_date_valid": _count("fact_sales", "order_date IS NULL"),
        "delivery_before_order": _count("fact_sales", "delivery_date < order_date"),
        "quantity_valid": _count("fact_sales", "quantity IS NULL OR quantity <= 0"),
        "price_valid": _count("dim_product", "unit_price_usd IS NULL OR unit_price_usd < 0"),
        "cost_valid": _count("dim_product", "unit_cost_usd IS NULL OR unit_cost_usd < 0"),
        "category_key_1to1": "(SELECT COUNT(*) FROM (SELECT category_key FROM dim_category "
        "GROUP BY 1 HAVING COUNT(DISTINCT category_name) > 1) AS t)",
        "customer_key_unique": _surplus("dim_customer", "customer_key"),
        "orphan_customer": FK["fact_sales.customer_key"],
        "order_has_lines": "(SELECT COUNT(*) FROM (SELECT order_number FROM fact_sales "
        "GROUP BY 1 HAVING COUNT(DISTINCT line_item) < 1) AS t)",
        "revenue_recompute": _count(
            "fact_sales", "COALESCE(abs(quantity * unit_price_usd - revenue_usd) >= 0.000001, TRUE)"
        ),
        "negative_profit": _count("fact_sales", "profit_usd < 0"),
        "fact_composite_key": composite,
        "duplicate_groups": "(SELECT COUNT(*) FROM (SELECT customer_key FROM dim_customer "
        "GROUP BY 1 HAVING COUNT(*) > 1) AS t)",
        "check_quantity_constraint": _count("fact_sales", "quantity <= 0"),
    }
    sql = {f"dq_{n}": query(_check(n, found)) for n, found in one.items()}
    positive = (
        f"SELECT 'total_revenue_positive' AS check_name, {dbl(TOTAL)} AS observed, "
        f"CAST(0 AS DOUBLE) AS threshold, {TOTAL} > 0 AS passed"
    )
    sql["dq_total_revenue_positive"] = query(positive)
    counts = {
        "dim_customer": "customer", "dim_product": "part", "dim_store": "supplier",
        "exchange_rate": "(SELECT * FROM exchange_rate) AS r", "fact_sales": "lineitem",
    }
    row_counts = [
        _check(t, f"((SELECT COUNT(*) FROM {t}) - (SELECT COUNT(*) FROM {s}))")
        for t, s in counts.items()
    ]
    sql["dq_row_counts"] = query("\nUNION ALL ".join(row_counts))
    numbers = {
        "sales": ("lineitem", "l_orderkey"), "customers": ("customer", "c_custkey"),
        "products": ("part", "p_partkey"), "stores": ("supplier", "s_suppkey"),
        "exchange_rates": ("exchange_rate", "exchange"),
    }
    sql["dq_unreadable_cells"] = query("\nUNION ALL ".join(
        _check(n, _count(t, f"{c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL"))
        for n, (t, c) in numbers.items()
    ))
    keys = {
        "dim_customer": "customer_key", "dim_product": "product_key", "dim_store": "store_key",
        "dim_category": "category_key", "dim_subcategory": "subcategory_key",
        "dim_date": "date_key",
    }
    primary = [
        _check(f"{t}.{k}", f"(SELECT COUNT(*) - COUNT(DISTINCT {k}) FROM {t})")
        for t, k in keys.items()
    ]
    sql["dq_primary_keys"] = query("\nUNION ALL ".join(primary))
    foreign = [_check(n, f) for n, f in FK.items()]
    foreign.append(_check("all_foreign_keys", "(" + " + ".join(FK.values()) + ")"))
    sql["dq_foreign_keys"] = query("\nUNION ALL ".join(foreign))
    direct = (
        "(SELECT SUM(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2))) "
        "FROM lineitem JOIN part ON l_partkey = p_partkey)"
    )
    reconciles = (
        f"SELECT 'revenue_reconciles' AS check_name, {dbl(f'abs({TOTAL} - {direct})')} AS observed, "
        f"CAST(0.01 AS DOUBLE) AS threshold, abs({TOTAL} - {direct}) < 0.01 AS passed"
    )
    sql["dq_revenue_reconciles"] = query(reconciles)
    slices = {
        "year": "(SELECT year(order_date) AS k, revenue_usd AS v FROM fact_sales)",
        "customer_country": "(SELECT c.country AS k, revenue_usd AS v FROM fact_sales f "
        "JOIN dim_customer c ON f.customer_key = c.customer_key)",
        "category_name": "(SELECT p.category_name AS k, revenue_usd AS v FROM fact_sales f "
        "JOIN flat p ON f.product_key = p.product_key)",
        "channel": "(SELECT s.is_online AS k, revenue_usd AS v FROM fact_sales f "
        "JOIN dim_store s ON f.store_key = s.store_key)",
        "store_country": "(SELECT s.country AS k, revenue_usd AS v FROM fact_sales f "
        "JOIN dim_store s ON f.store_key = s.store_key)",
    }
    gaps = []
    for name, rows in slices.items():
        gap = (
            f"abs((SELECT SUM(r) FROM (SELECT k, SUM(v) AS r FROM {rows} AS x "
            f"WHERE k IS NOT NULL GROUP BY k) AS y) - {TOTAL})"
        )
        gaps.append(
            f"SELECT '{name}' AS check_name, {dbl(gap)} AS observed, "
            f"CAST(0.01 AS DOUBLE) AS threshold, {gap} < 0.01 AS passed"
        )
    sql["dq_slice_reconciliation"] = query("\nUNION ALL ".join(gaps))
    clean = [n for n in list(one)[:12]]
    sql["dq_clean_suite"] = query(
        "\nUNION ALL ".join([_check(n, one[n]) for n in clean] + [positive])
    )
    sql["dq_star_suite"] = query(
        "\nUNION ALL ".join(
            [*row_counts, *primary, _check("fact_composite_key", composite), *foreign,
             _check("duplicate_groups", one["duplicate_groups"]), reconciles]
        )
    )
    return sql


SALES_COLUMNS = {
    "Order Number": ("order_number", "bigint"), "Line Item": ("line_item", "bigint"),
    "Order Date": ("order_date", "string"), "Delivery Date": ("delivery_date", "string"),
    "CustomerKey": ("customer_key", "bigint"), "StoreKey": ("store_key", "bigint"),
    "ProductKey": ("product_key", "bigint"), "Quantity": ("quantity", "int"),
    "Currency Code": ("currency_code", "string"),
}
CUSTOMER_COLUMNS = {
    "CustomerKey": ("customer_key", "bigint"), "Gender": ("gender", "string"),
    "Name": ("name", "string"), "City": ("city", "string"),
    "State Code": ("state_code", "string"), "State": ("state", "string"),
    "Zip Code": ("zip_code", "string"), "Country": ("country", "string"),
    "Continent": ("continent", "string"), "Birthday": ("birthday", "string"),
}
PRODUCT_COLUMNS = {
    "ProductKey": ("product_key", "bigint"), "Product Name": ("product_name", "string"),
    "Brand": ("brand", "string"), "Color": ("color", "string"),
    "Unit Cost USD": ("unit_cost_usd", "string"), "Unit Price USD": ("unit_price_usd", "string"),
    "SubcategoryKey": ("subcategory_key", "string"),
    "Subcategory": ("subcategory_name", "string"), "CategoryKey": ("category_key", "string"),
    "Category": ("category_name", "string"),
}
STORE_COLUMNS = {
    "StoreKey": ("store_key", "bigint"), "Country": ("country", "string"),
    "State": ("state", "string"), "Square Meters": ("square_meters", "double"),
    "Open Date": ("open_date", "string"),
}
RATE_COLUMNS = {
    "Date": ("rate_date", "string"), "Currency": ("currency", "string"),
    "Exchange": ("exchange", "double"),
}
RAW = {
    "sales": ("fact_sales", SALES_COLUMNS),
    "customers": ("dim_customer", CUSTOMER_COLUMNS),
    "products": (
        "(SELECT p.*, subcategory_name, category_key, category_name FROM dim_product p "
        "JOIN flat f ON p.product_key = f.product_key) AS pr",
        PRODUCT_COLUMNS,
    ),
    "stores": ("dim_store", STORE_COLUMNS),
    "exchange_rates": ("exchange_rate", RATE_COLUMNS),
}


def _list(col: str) -> str:
    return f"COALESCE(string_agg(DISTINCT {col}, ', ' ORDER BY {col}), '')"


def profile_oracles() -> dict[str, str]:
    sql = {}
    tables, columns = [], []
    for name, (source, cols) in RAW.items():
        own = ", ".join(c for c, _ in cols.values())
        tables.append(
            f"SELECT '{name}' AS table_name, (SELECT COUNT(*) FROM {source}) AS n_rows, "
            f"CAST({len(cols)} AS INTEGER) AS n_columns, "
            f"(SELECT COUNT(*) FROM {source}) - (SELECT COUNT(*) FROM "
            f"(SELECT DISTINCT {own} FROM {source}) AS d) AS duplicate_rows"
        )
        for label, (col, kind) in cols.items():
            columns.append(
                f"SELECT '{name}' AS table_name, '{label}' AS column_name, '{kind}' AS data_type, "
                f"COUNT(*) - COUNT({col}) AS missing, "
                f"{pct(f'COUNT(*) - COUNT({col})', 'COUNT(*)')} AS missing_pct FROM {source}"
            )
    sql["profile_tables"] = query("\nUNION ALL ".join(tables))
    sql["profile_columns"] = query("\nUNION ALL ".join(columns))
    keys = {
        "order_number": "order_number", "order_line": "(order_number, line_item)",
        "customer_key": "customer_key", "product_key": "product_key", "store_key": "store_key",
        "currency_code": "currency_code",
    }
    parts = [
        f"SELECT '{n}' AS key_name, COUNT(DISTINCT {e}) AS distinct_values FROM fact_sales"
        for n, e in keys.items()
    ]
    sql["profile_sales_keys"] = query("\nUNION ALL ".join(parts))
    sql["profile_order_dates"] = query(f"""
SELECT MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
  {big("COUNT(*) - COUNT(order_date)")} AS order_date_unreadable,
  {big("COUNT(*) - COUNT(delivery_date)")} AS delivery_date_missing,
  {pct("COUNT(*) - COUNT(delivery_date)", "COUNT(*)")} AS delivery_date_missing_pct,
  CAST(0 AS BIGINT) AS delivery_date_invalid
FROM fact_sales""")
    sql["profile_quantity"] = query(f"""
SELECT MIN(quantity) AS min_quantity, MAX(quantity) AS max_quantity,
  {rnd("SUM(quantity) / COUNT(quantity)")} AS mean_quantity,
  {big("COUNT(*) FILTER (WHERE quantity <= 0)")} AS not_positive
FROM fact_sales""")
    sql["profile_products"] = query(f"""
SELECT COUNT(DISTINCT p.product_key) AS products,
  {dbl("MIN(unit_cost_usd)")} AS min_cost_usd, {dbl("MAX(unit_cost_usd)")} AS max_cost_usd,
  COUNT(*) FILTER (WHERE unit_cost_usd IS NULL) AS cost_unreadable,
  {dbl("MIN(unit_price_usd)")} AS min_price_usd, {dbl("MAX(unit_price_usd)")} AS max_price_usd,
  COUNT(*) FILTER (WHERE unit_price_usd IS NULL) AS price_unreadable,
  COUNT(*) FILTER (WHERE unit_price_usd < unit_cost_usd) AS price_below_cost,
  COUNT(DISTINCT category_name) AS categories,
  COUNT(DISTINCT subcategory_name) AS subcategories, COUNT(DISTINCT p.brand) AS brands
FROM dim_product p JOIN flat f ON p.product_key = f.product_key""")
    sql["profile_customers"] = query(f"""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT customer_key) AS customers,
  COUNT(*) = COUNT(DISTINCT customer_key) AS key_unique,
  COUNT(DISTINCT country) AS countries, COUNT(DISTINCT continent) AS continents,
  COUNT(*) FILTER (WHERE gender = 'Female') AS female,
  COUNT(*) FILTER (WHERE gender = 'Male') AS male
FROM dim_customer""")
    sql["profile_gender_counts"] = query(
        "SELECT gender, COUNT(*) AS n_rows FROM dim_customer GROUP BY 1"
    )
    sql["profile_stores"] = query(f"""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT store_key) AS stores,
  COUNT(DISTINCT country) AS countries, MIN(square_meters) AS min_square_meters,
  MAX(square_meters) AS max_square_meters,
  COUNT(*) FILTER (WHERE square_meters IS NULL) AS missing_square_meters,
  (SELECT string_agg(CAST(store_key AS VARCHAR), ', ' ORDER BY store_key) FROM
    (SELECT DISTINCT store_key FROM dim_store ORDER BY 1 LIMIT 5) AS a) AS first_keys,
  (SELECT string_agg(CAST(store_key AS VARCHAR), ', ' ORDER BY store_key) FROM
    (SELECT DISTINCT store_key FROM dim_store ORDER BY 1 DESC LIMIT 3) AS b) AS last_keys
FROM dim_store""")
    sql["profile_fx"] = query(f"""
SELECT MIN(rate_date) AS first_rate_date, MAX(rate_date) AS last_rate_date,
  COUNT(DISTINCT currency) AS currencies
FROM exchange_rate""")
    refs = {"customer_key": "dim_customer", "product_key": "dim_product", "store_key": "dim_store"}
    sql["profile_referential"] = query(
        "\nUNION ALL ".join(
            f"SELECT '{k}' AS key_name, COUNT(*) AS orphan_rows, "
            f"COUNT(DISTINCT f.{k}) AS orphan_keys FROM fact_sales f "
            f"LEFT JOIN {t} d ON f.{k} = d.{k} WHERE d.{k} IS NULL"
            for k, t in refs.items()
        )
    )
    sql["profile_currency_gap"] = query(f"""
SELECT currency_code AS currency, COUNT(*) AS n_lines
FROM fact_sales WHERE currency_code NOT IN (SELECT currency FROM exchange_rate) GROUP BY 1""")
    listed = [
        ("sales", "Currency Code", "fact_sales", "currency_code"),
        ("products", "Category", "(dim_product p JOIN flat f ON p.product_key = f.product_key)", "category_name"),
        ("customers", "Continent", "dim_customer", "continent"),
        ("stores", "Country", "dim_store", "country"),
        ("exchange_rates", "Currency", "exchange_rate", "currency"),
    ]
    sql["profile_values"] = query("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {col} AS value, COUNT(*) AS n_rows "
        f"FROM {source} GROUP BY {col}"
        for t, c, source, col in listed
    ))
    sql["profile_fx_coverage"] = query("""
SELECT a AS first_order_date, b AS last_order_date, ra AS first_rate_date, rb AS last_rate_date,
  ra <= a AND rb >= b AS covered
FROM (SELECT MIN(order_date) AS a, MAX(order_date) AS b FROM fact_sales) AS s,
  (SELECT MIN(rate_date) AS ra, MAX(rate_date) AS rb FROM exchange_rate) AS r""")
    sql["profile_duplicate_names"] = query(f"""
SELECT COUNT(*) AS shared_names, {big("COALESCE(SUM(k), 0)")} AS customers_sharing
FROM (SELECT name, COUNT(DISTINCT customer_key) AS k FROM dim_customer GROUP BY 1
  HAVING COUNT(DISTINCT customer_key) > 1) AS t""")
    return sql
