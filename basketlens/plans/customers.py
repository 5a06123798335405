"""Customer reports: repeat purchase, frequency, deciles, acquisition, lifespan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import (
    customer_type_label,
    lifespan_label,
    percent2,
    ratio2,
    usd,
    usd_per,
    year_completeness_label,
)
from basketlens.operators.ranking import global_row_number, ntile_of, top_k
from basketlens.sources.star import Star


def _share_within(col: str) -> Column:
    """Percent of the sum over the (few) result rows."""
    return percent2(col, F.sum(col).over(Window.partitionBy()))


def customers_with_zero_orders(star: Star) -> DataFrame:
    """Registered customers against those with an order."""
    buyers = star.customers().agg(F.count("customer_key").alias("buyers"))
    registered = star.table("dim_customer").agg(F.count(F.lit(1)).alias("registered"))
    never = F.col("registered") - F.col("buyers")
    return registered.withColumn("buyers", buyers.scalar()).select(
        F.col("registered").alias("total_customers_in_master_data"),
        F.col("buyers").alias("customers_with_at_least_one_order"),
        never.alias("customers_never_ordered"),
        percent2(never, "registered").alias("pct_never_ordered"),
    )


def repeat_vs_onetime_customers(star: Star) -> DataFrame:
    return (
        star.customers("orders")
        .groupBy(customer_type_label("orders").alias("customer_type"))
        .agg(F.count(F.lit(1)).alias("num_customers"))
        .withColumn("pct_of_customers", _share_within("num_customers"))
    )


def revenue_contribution_repeat_vs_onetime(star: Star) -> DataFrame:
    by_type = (
        star.customers("orders", "revenue_cents")
        .groupBy(customer_type_label("orders").alias("customer_type"))
        .agg(
            F.count(F.lit(1)).alias("num_customers"),
            F.sum("revenue_cents").alias("r"),
            F.count("revenue_cents").alias("with_revenue"),
        )
    )
    # Every fact row belongs to a customer, so the rows here add up to the
    # whole fact table.
    return by_type.select(
        "customer_type",
        "num_customers",
        usd("r").alias("total_revenue_usd"),
        _share_within("r").alias("pct_of_total_revenue"),
        usd_per("r", "with_revenue").alias("avg_revenue_per_customer_usd"),
    )


def purchase_frequency_distribution(star: Star) -> DataFrame:
    return (
        star.customers("orders")
        .groupBy(F.col("orders").alias("orders_placed"))
        .agg(F.count(F.lit(1)).alias("num_customers"))
        .withColumn("pct_of_customers", _share_within("num_customers"))
        .orderBy("orders_placed")
    )


def top_20_customers_by_revenue(star: Star, k: int = 20) -> DataFrame:
    spend = star.customers("orders", "revenue_cents")
    named = spend.join(
        star.customer_flat("customer_name", "customer_country"), "customer_key"
    )
    best = top_k(named, k, "revenue_cents", ["customer_key"], "revenue_rank")
    return best.select(
        "customer_key",
        F.col("customer_name").alias("name"),
        F.col("customer_country").alias("country"),
        F.col("orders").alias("total_orders"),
        usd("revenue_cents").alias("total_revenue_usd"),
        "revenue_rank",
    )


def customer_deciles(star: Star, tiles: int = 10) -> DataFrame:
    """Each customer's revenue and its tile; tile 1 spends most."""
    spend = star.customers("revenue_cents").withColumn("_down", -F.col("revenue_cents"))
    ranked = global_row_number(spend, "_down", "customer_key")
    return ranked.select(
        "customer_key",
        "revenue_cents",
        ntile_of("row_index", "row_total", tiles).alias("decile"),
    )


def revenue_concentration_deciles(star: Star) -> DataFrame:
    deciles = (
        customer_deciles(star)
        .groupBy("decile")
        .agg(F.count(F.lit(1)).alias("num_customers"), F.sum("revenue_cents").alias("r"))
    )
    # Ten rows from here on.
    running = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("r").over(Window.partitionBy())
    return deciles.select(
        "decile",
        "num_customers",
        usd("r").alias("decile_revenue_usd"),
        percent2("r", total).alias("pct_of_total_revenue"),
        percent2(F.sum("r").over(running), total).alias("cumulative_pct_of_revenue"),
    ).orderBy("decile")


def new_customers_per_year(star: Star) -> DataFrame:
    per_year = (
        star.customers("first_date", "last_date")
        .groupBy(F.year("first_date").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("new_customers"),
            F.max(F.year("last_date")).alias("_last"),
        )
    )
    last_year = F.max("_last").over(Window.partitionBy())
    return per_year.select(
        "year",
        "new_customers",
        year_completeness_label("year", last_year).alias("year_completeness"),
    ).orderBy("year")


def avg_spend_and_frequency_by_country(star: Star) -> DataFrame:
    # The customer table joins after the reduction to one row per customer.
    # Customers without a master row count in the revenue total only.
    masters = star.customer_flat("customer_country").withColumn("matched", F.lit(True))
    summary = star.customers("orders", "revenue_cents").join(masters, "customer_key", "left")
    by_country = summary.groupBy(F.col("customer_country").alias("country"), "matched").agg(
        F.count(F.lit(1)).alias("num_customers"),
        F.sum("orders").alias("o"),
        F.sum("revenue_cents").alias("r"),
        F.count("revenue_cents").alias("with_revenue"),
    )
    shared = by_country.withColumn("pct_of_total_revenue", _share_within("r")).where("matched")
    return shared.select(
        "country",
        "num_customers",
        ratio2("o", "num_customers").alias("avg_orders_per_customer"),
        usd_per("r", "with_revenue").alias("avg_revenue_per_customer_usd"),
        usd("r").alias("total_revenue_usd"),
        "pct_of_total_revenue",
    ).orderBy(F.col("total_revenue_usd").desc(), "country")


def customer_lifespan_summary(star: Star) -> DataFrame:
    spans = star.customers("orders", "first_date", "last_date")
    days = F.datediff("last_date", "first_date")
    return (
        spans.groupBy(lifespan_label("orders", days).alias("lifespan_bucket"))
        .agg(F.count(F.lit(1)).alias("num_customers"))
        .withColumn("pct_of_customers", _share_within("num_customers"))
        .orderBy(F.col("num_customers").desc(), "lifespan_bucket")
    )
