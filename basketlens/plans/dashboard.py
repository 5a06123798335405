"""Row sets behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.scalars import WEEKDAYS, percent, percent2, ratio, usd, usd_per
from basketlens.plans.customers import customer_deciles
from basketlens.plans.measures import measures_by
from basketlens.sources.star import Star


def weekday_channel_orders(star: Star) -> DataFrame:
    counts = star.lines("weekday", "channel", "order_number").groupBy("weekday", "channel").agg(
        F.count_distinct("order_number").alias("orders")
    )
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return counts.select(
        "weekday", F.get(names, F.col("weekday")).alias("day_name"), "channel", "orders"
    )


def product_margin_tiers(star: Star) -> DataFrame:
    """Catalogue products per rounded list margin."""
    price, cost = F.col("unit_price_usd"), F.col("unit_cost_usd")
    return (
        star.table("dim_product")
        .groupBy(percent2(price - cost, price).alias("margin_pct"))
        .agg(F.count(F.lit(1)).alias("products"))
    )


def bottom_half_revenue_share(star: Star) -> DataFrame:
    """Revenue share of the customers in deciles 6 to 10."""
    deciles = customer_deciles(star)
    low = F.col("decile") >= 6
    return deciles.agg(
        F.count(F.when(low, 1)).alias("customers"),
        usd(F.sum(F.when(low, F.col("revenue_cents")))).alias("revenue_usd"),
        percent2(F.sum(F.when(low, F.col("revenue_cents"))), F.sum("revenue_cents")).alias("pct_of_total_revenue"),
    )


def top_customer_share(star: Star) -> DataFrame:
    """The largest customer and its part of all revenue."""
    best = star.customers("revenue_cents").orderBy(
        F.col("revenue_cents").desc_nulls_last(), "customer_key"
    ).limit(1)
    return best.select(
        "customer_key",
        usd("revenue_cents").alias("revenue_usd"),
        F.round(percent("revenue_cents", star.revenue_total().scalar()), 4).alias(
            "pct_of_total_revenue"
        ),
    )


def new_vs_returning_by_year(star: Star) -> DataFrame:
    """Active customers per year: first order that year, or earlier."""
    by_year = measures_by(star, ["total_customers", "new_customers"], ["year"])
    return by_year.select(
        "year",
        "new_customers",
        (F.col("total_customers") - F.col("new_customers")).alias("returning_customers"),
        "total_customers",
    )


def drill_category(star: Star) -> DataFrame:
    """Revenue on every level of category > subcategory > product."""
    levels = ["category_name", "subcategory_key", "product_key"]
    products = star.product_totals("revenue_cents").join(
        star.product_flat("category_name", "subcategory_key"), "product_key"
    )
    return products.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_mask"), usd(F.sum("revenue_cents")).alias("revenue_usd")
    )


def drill_date(star: Star) -> DataFrame:
    """Revenue on every level of year > quarter > month."""
    levels = ["year", "quarter", "month"]
    # Months first, so the roll-up expands a few rows instead of the orders.
    months = star.orders(*levels, "revenue_cents").groupBy(*levels).agg(
        F.sum("revenue_cents").alias("r")
    )
    return months.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_mask"), usd(F.sum("r")).alias("revenue_usd")
    )


HEADLINE = [
    "total_revenue", "total_orders", "total_customers", "units_sold", "average_order_value",
    "revenue_per_customer", "historical_clv", "revenue_yoy_growth_pct", "repeat_customers",
    "repeat_purchase_rate_pct",
]


def sliced_kpis(
    star: Star, dims: list[str] | None = None, filters: dict[str, object] | None = None
) -> DataFrame:
    """The ten model measures under a choice of slicers."""
    return measures_by(star, HEADLINE, dims, filters)


def trend_tooltip(star: Star) -> DataFrame:
    months = (
        star.orders("year_month", "order_number", "revenue_cents")
        .groupBy("year_month")
        .agg(F.sum("revenue_cents").alias("r"), F.count_distinct("order_number").alias("orders"))
    )
    return months.select(
        "year_month", usd("r").alias("revenue_usd"), "orders",
        usd_per("r", "orders").alias("aov_usd"),
    )


def implicit_totals(star: Star, segments: DataFrame) -> DataFrame:
    """Default aggregations of plain model columns, one row."""
    rfm = segments.agg(
        F.round(ratio(F.sum("recency_days"), F.count("recency_days")), 6).alias("avg_recency_days"),
        F.round(ratio(F.sum("frequency"), F.count("frequency")), 6).alias("avg_frequency"),
        usd(F.sum("monetary_cents")).alias("sum_monetary_usd"),
    )
    area = star.table("dim_store").agg(F.sum("square_meters").alias("a")).scalar()
    return rfm.withColumn("sum_square_meters", area)
