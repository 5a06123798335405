"""Sales reports: KPIs, growth, products, categories, geography, channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import percent2, usd, usd_per, year_completeness_label
from basketlens.operators.ranking import top_k
from basketlens.sources.star import Star


def _usd_total(cents: str, name: str) -> Column:
    return usd(cents).alias(name)


def _with_share(by_group: DataFrame) -> DataFrame:
    """Add the percent of the whole fact table's revenue ``r``.

    Expects groups that also hold the rows without their dimension: those
    count in the total and are then dropped. Groups are few, so a window over
    all of them is small, and no second scan is needed for the total.
    """
    total = F.sum("r").over(Window.partitionBy())
    return by_group.withColumn("pct_of_total_revenue", percent2("r", total)).where("matched")


def _per(cents: str, count: str) -> Column:
    return usd_per(cents, count)


def _growth(cents: str, window: Window) -> Column:
    before = F.lag(cents).over(window)
    return percent2(F.col(cents) - before, before)


def _orders_and_customers(
    star: Star, orders: DataFrame, dims: list[str], sums: list[str] | None = None
) -> DataFrame:
    """Revenue ``r``, orders ``o``, customers ``c`` and further sums per group of order rows.

    Where a star promises one customer per order, orders are counted per
    customer and customers then counted: two plain aggregates in place of two
    distinct counts, for which every row would be copied twice.
    """
    totals = [F.sum(s).cast("bigint").alias(s) for s in sums or []]
    if not star.one_customer_per_order:
        return orders.groupBy(*dims).agg(
            F.sum("revenue_cents").alias("r"),
            F.count_distinct("order_number").alias("o"),
            F.count_distinct("customer_key").alias("c"),
            *totals,
        )
    per_customer = orders.groupBy(*dims, "customer_key").agg(
        F.sum("revenue_cents").alias("r"), F.count("order_number").alias("o"), *totals
    )
    return per_customer.groupBy(*dims).agg(
        F.sum("r").alias("r"),
        F.coalesce(F.sum("o"), F.lit(0)).alias("o"),
        F.count("customer_key").alias("c"),
        *totals,
    )


def kpi_summary(star: Star) -> DataFrame:
    orders = star.orders("order_number", "customer_key", "revenue_cents", "quantity")
    totals = _orders_and_customers(star, orders, [], ["quantity"])
    return totals.select(
        _usd_total("r", "total_revenue_usd"),
        F.col("o").alias("total_orders"),
        F.col("c").alias("total_customers_who_ordered"),
        F.col("quantity").alias("total_units_sold"),
        _per("r", "o").alias("avg_order_value_usd"),
        _per("r", "c").alias("avg_revenue_per_customer_usd"),
    )


def monthly_revenue_and_growth(star: Star) -> DataFrame:
    monthly = (
        star.orders("order_number", "year_month", "revenue_cents")
        .groupBy("year_month")
        .agg(F.sum("revenue_cents").alias("r"), F.count_distinct("order_number").alias("orders"))
    )
    # One row per calendar month.
    w = Window.orderBy("year_month")
    return monthly.select(
        "year_month",
        _usd_total("r", "revenue_usd"),
        "orders",
        usd(F.col("r") - F.lag("r").over(w)).alias("revenue_change_usd"),
        _growth("r", w).alias("mom_growth_pct"),
    ).orderBy("year_month")


def yearly_revenue_and_growth(star: Star) -> DataFrame:
    yearly = (
        star.orders("order_number", "year", "revenue_cents")
        .groupBy("year")
        .agg(F.sum("revenue_cents").alias("r"), F.count_distinct("order_number").alias("orders"))
    )
    # One row per year, so the last year is known without another scan.
    last_year = F.max("year").over(Window.partitionBy())
    w = Window.orderBy("year")
    return yearly.select(
        "year",
        _usd_total("r", "revenue_usd"),
        "orders",
        _growth("r", w).alias("yoy_growth_pct"),
        year_completeness_label("year", last_year).alias("year_completeness"),
    ).orderBy("year")


# -- products ----------------------------------------------------------------


def _product_report(star: Star, totals: list[str], attributes: list[str]) -> DataFrame:
    """Sold products with attributes: aggregate first, then join one to one."""
    return star.product_totals(*totals).join(star.product_flat(*attributes), "product_key")


def top_10_products_by_revenue(star: Star, k: int = 10) -> DataFrame:
    products = _product_report(
        star, ["revenue_cents", "quantity"], ["product_name", "brand", "category_name"]
    )
    best = top_k(products, k, "revenue_cents", ["product_key"], "revenue_rank")
    return best.select(
        "product_name", "brand", "category_name",
        _usd_total("revenue_cents", "total_revenue_usd"),
        F.col("quantity").alias("total_units_sold"),
        "revenue_rank",
    )


def top_10_products_by_quantity(star: Star, k: int = 10) -> DataFrame:
    products = _product_report(
        star, ["revenue_cents", "quantity"], ["product_name", "brand", "category_name"]
    )
    best = top_k(products, k, "quantity", ["product_key"], "quantity_rank")
    return best.select(
        "product_name", "brand", "category_name",
        F.col("quantity").alias("total_units_sold"),
        _usd_total("revenue_cents", "total_revenue_usd"),
        "quantity_rank",
    )


def bottom_10_products_by_revenue(star: Star, k: int = 10) -> DataFrame:
    """Weakest products among those sold at least once."""
    products = _product_report(
        star, ["revenue_cents", "quantity"], ["product_name", "brand", "category_name"]
    )
    worst = top_k(products, k, "revenue_cents", ["product_key"], ascending=True)
    return worst.select(
        "product_name", "brand", "category_name",
        _usd_total("revenue_cents", "total_revenue_usd"),
        F.col("quantity").alias("total_units_sold"),
    )


def products_never_sold(star: Star) -> DataFrame:
    # The sold side is one row per product before the join, so a best seller
    # weighs no more than any other product.
    sold = star.product_totals("n_lines").select("product_key")
    products = star.table("dim_product").select("product_key")
    return products.join(sold, "product_key", "left_anti").agg(
        F.count(F.lit(1)).alias("products_never_sold")
    )


def product_profitability_top10(star: Star, k: int = 10) -> DataFrame:
    products = _product_report(
        star, ["revenue_cents", "profit_cents"], ["product_name", "category_name"]
    )
    best = top_k(products, k, "profit_cents", ["product_key"])
    return best.select(
        "product_name", "category_name",
        _usd_total("revenue_cents", "total_revenue_usd"),
        _usd_total("profit_cents", "total_profit_usd"),
        percent2("profit_cents", "revenue_cents").alias("profit_margin_pct"),
    )


# -- categories --------------------------------------------------------------


def category_revenue(star: Star) -> DataFrame:
    by_category = (
        star.lines(
            "category_name", "order_number", "revenue_cents", "quantity", unmatched=True
        )
        .groupBy("category_name", "matched")
        .agg(
            F.sum("revenue_cents").alias("r"),
            F.sum("quantity").alias("total_units_sold"),
            F.count_distinct("order_number").alias("orders_containing_category"),
        )
    )
    # A handful of categories: one task may rank them.
    return _with_share(by_category).select(
        "category_name",
        _usd_total("r", "total_revenue_usd"),
        "total_units_sold",
        "orders_containing_category",
        "pct_of_total_revenue",
        F.rank().over(Window.orderBy(F.col("r").desc())).alias("revenue_rank"),
    ).orderBy(F.col("total_revenue_usd").desc(), "category_name")


def category_growth_yoy(star: Star) -> DataFrame:
    """Category revenue per year without the last (partial) year."""
    cat_year = (
        star.lines("category_name", "year", "revenue_cents", unmatched=True)
        .groupBy("category_name", "year", "matched")
        .agg(F.sum("revenue_cents").alias("r"))
    )
    # The last year of the whole fact table, also of rows without a category.
    last_year = F.max("year").over(Window.partitionBy())
    w = Window.partitionBy("category_name").orderBy("year")
    return (
        cat_year.withColumn("last_year", last_year)
        .where("matched AND year <> last_year")
        .select(
            "category_name",
            "year",
            _usd_total("r", "revenue_usd"),
            _growth("r", w).alias("yoy_growth_pct"),
        )
        .orderBy("category_name", "year")
    )


def category_profit_margin(star: Star) -> DataFrame:
    # Additive measures only, so products are summed before the category joins.
    by_category = (
        _product_report(star, ["revenue_cents", "profit_cents"], ["category_name"])
        .groupBy("category_name")
        .agg(F.sum("revenue_cents").alias("r"), F.sum("profit_cents").alias("p"))
    )
    return by_category.select(
        "category_name",
        _usd_total("r", "total_revenue_usd"),
        _usd_total("p", "total_profit_usd"),
        percent2("p", "r").alias("profit_margin_pct"),
    ).orderBy(F.col("profit_margin_pct").desc(), "category_name")


# -- geography and channel ---------------------------------------------------


def revenue_by_customer_country(star: Star) -> DataFrame:
    orders = (
        star.orders(
            "customer_country", "order_number", "customer_key", "revenue_cents", unmatched=True
        )
    )
    by_country = _orders_and_customers(
        star, orders, ["customer_country", "matched"]
    ).withColumnsRenamed({"o": "total_orders", "c": "total_customers"})
    return _with_share(by_country).select(
        F.col("customer_country").alias("country"),
        _usd_total("r", "total_revenue_usd"),
        "total_orders",
        "total_customers",
        _per("r", "total_orders").alias("aov_usd"),
        "pct_of_total_revenue",
        F.rank().over(Window.orderBy(F.col("r").desc())).alias("revenue_rank"),
    ).orderBy(F.col("total_revenue_usd").desc(), "country")


def revenue_by_customer_state_top15(star: Star, k: int = 15) -> DataFrame:
    by_state = (
        star.orders("customer_country", "customer_state", "order_number", "revenue_cents")
        .groupBy("customer_country", "customer_state")
        .agg(
            F.sum("revenue_cents").alias("r"),
            F.count_distinct("order_number").alias("total_orders"),
        )
    )
    best = top_k(by_state, k, "r", ["customer_country", "customer_state"])
    return best.select(
        F.col("customer_country").alias("country"),
        F.col("customer_state").alias("state"),
        _usd_total("r", "total_revenue_usd"),
        "total_orders",
        _per("r", "total_orders").alias("aov_usd"),
    )


def revenue_by_channel(star: Star) -> DataFrame:
    by_channel = (
        star.lines("channel", "order_number", "revenue_cents", "quantity", unmatched=True)
        .groupBy("channel", "matched")
        .agg(
            F.sum("revenue_cents").alias("r"),
            F.count_distinct("order_number").alias("total_orders"),
            F.sum("quantity").alias("total_units_sold"),
        )
    )
    return _with_share(by_channel).select(
        "channel",
        _usd_total("r", "total_revenue_usd"),
        "total_orders",
        "total_units_sold",
        _per("r", "total_orders").alias("aov_usd"),
        "pct_of_total_revenue",
    ).orderBy(F.col("total_revenue_usd").desc(), "channel")


def revenue_by_store_country(star: Star) -> DataFrame:
    """Store-side geography; only stores with sales are counted."""
    # Reduced to (order, store) first; orders and stores are then counted apart.
    visits = (
        star.fact("order_number", "store_key", "revenue_cents")
        .groupBy("order_number", "store_key")
        .agg(F.sum("revenue_cents").alias("r"))
    )
    countries = star.store_flat("store_country")
    orders = (
        star.look_up(visits, countries, "store_key")
        .groupBy("store_country", "order_number")
        .agg(F.sum("r").alias("r"))
        .groupBy("store_country")
        .agg(F.sum("r").alias("r"), F.count("order_number").alias("total_orders"))
    )
    stores = (
        visits.select("store_key").distinct().join(countries, "store_key")
        .groupBy(F.col("store_country").alias("country"))
        .agg(F.count("store_key").alias("store_count"))
    )
    by_country = orders.join(stores, F.col("store_country").eqNullSafe(F.col("country"))).drop("country")
    return by_country.select(
        F.col("store_country").alias("country"),
        _usd_total("r", "total_revenue_usd"),
        "total_orders",
        "store_count",
        _per("r", "store_count").alias("avg_revenue_per_store_usd"),
    ).orderBy(F.col("total_revenue_usd").desc(), "country")
