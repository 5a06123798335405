"""Raw text tables to clean typed tables, and those to the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.scalars import (
    AMOUNT,
    RATE,
    is_online_country,
    parse_money,
    parse_raw_date,
)
from basketlens.operators.joins import lookup_join
from basketlens.sources.star import Star, calendar, with_date_parts

# -- cleaning ----------------------------------------------------------------


def clean_customers(raw: DataFrame) -> DataFrame:
    """Birthday to date; zip code stays text; a missing state code stays null."""
    return raw.select(
        F.col("CustomerKey").alias("customer_key"),
        F.col("Gender").alias("gender"),
        F.col("Name").alias("name"),
        F.col("City").alias("city"),
        F.col("State Code").alias("state_code"),
        F.col("State").alias("state"),
        F.col("Zip Code").cast("string").alias("zip_code"),
        F.col("Country").alias("country"),
        F.col("Continent").alias("continent"),
        parse_raw_date("Birthday").alias("birthday"),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("ProductKey").alias("product_key"),
        F.col("Product Name").alias("product_name"),
        F.col("Brand").alias("brand"),
        F.col("Color").alias("color"),
        parse_money("Unit Cost USD").alias("unit_cost_usd"),
        parse_money("Unit Price USD").alias("unit_price_usd"),
        F.col("SubcategoryKey").cast("string").alias("subcategory_key"),
        F.col("Subcategory").alias("subcategory_name"),
        F.col("CategoryKey").cast("string").alias("category_key"),
        F.col("Category").alias("category_name"),
    )


def clean_stores(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("StoreKey").alias("store_key"),
        F.col("Country").alias("country"),
        F.col("State").alias("state"),
        F.col("Square Meters").alias("square_meters"),
        parse_raw_date("Open Date").alias("open_date"),
        is_online_country("Country").alias("is_online"),
    )


def clean_exchange_rates(raw: DataFrame) -> DataFrame:
    return raw.select(
        parse_raw_date("Date").alias("rate_date"),
        F.col("Currency").alias("currency"),
        F.col("Exchange").cast(RATE).alias("exchange"),
    )


def clean_sales(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Typed sales lines priced from the clean products.

    The price lookup is a left join on a unique key: the row count stays. A
    missing delivery date stays null and only sets the flag. Amounts are in
    USD list prices; no exchange rate is involved.
    """
    typed = raw.select(
        F.col("Order Number").alias("order_number"),
        F.col("Line Item").alias("line_item"),
        parse_raw_date("Order Date").alias("order_date"),
        parse_raw_date("Delivery Date").alias("delivery_date"),
        F.col("CustomerKey").alias("customer_key"),
        F.col("StoreKey").alias("store_key"),
        F.col("ProductKey").alias("product_key"),
        F.col("Quantity").alias("quantity"),
        F.col("Currency Code").alias("currency_code"),
    )
    prices = products.select("product_key", "unit_price_usd", "unit_cost_usd")
    quantity = F.col("quantity").cast("decimal(10,0)")
    revenue = (quantity * F.col("unit_price_usd")).cast(AMOUNT)
    cost = (quantity * F.col("unit_cost_usd")).cast(AMOUNT)
    return (
        lookup_join(typed, prices, "product_key", "left")
        .withColumn("is_delivered", F.col("delivery_date").isNotNull())
        .withColumn("revenue_usd", revenue)
        .withColumn("cost_usd", cost)
        .withColumn("profit_usd", (revenue - cost).cast(AMOUNT))
    )


# -- star --------------------------------------------------------------------


def build_star(raw: Mapping[str, DataFrame]) -> Star:
    """Clean every raw table and lay the results out as a star."""
    products = clean_products(raw["products"])
    sales = clean_sales(raw["sales"], products)
    span = sales.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return Star(
        {
            "dim_category": products.select("category_key", "category_name").distinct(),
            "dim_subcategory": products.select(
                "subcategory_key", "subcategory_name", "category_key"
            ).distinct(),
            "dim_product": products.select(
                "product_key", "product_name", "brand", "color", "unit_cost_usd",
                "unit_price_usd", "subcategory_key",
            ),
            "dim_customer": clean_customers(raw["customers"]),
            "dim_store": clean_stores(raw["stores"]),
            "dim_date": with_date_parts(span.select(*calendar(F.col("a"), F.col("b")))),
            "exchange_rate": clean_exchange_rates(raw["exchange_rates"]),
            "fact_sales": sales.select(
                "order_number", "line_item", "order_date", "delivery_date", "is_delivered",
                "customer_key", "store_key", "product_key", "quantity", "currency_code",
                "unit_price_usd", "unit_cost_usd", "revenue_usd", "cost_usd", "profit_usd",
            ),
        }
    )


# -- optional local currency -------------------------------------------------


def revenue_local_currency(star: Star) -> DataFrame:
    """Revenue per currency and year, also in the customer's currency.

    Rates are units per dollar on the order date. Lines are summed per (date,
    currency) first, one row per rate, so the rate join is small and even.
    """
    daily = (
        star.fact("order_date", "currency_code", "revenue_cents")
        .groupBy("order_date", "currency_code")
        .agg(F.sum("revenue_cents").alias("r"), F.count(F.lit(1)).alias("n"))
    )
    rates = star.table("exchange_rate").select(
        F.col("rate_date").alias("order_date"),
        F.col("currency").alias("currency_code"),
        "exchange",
    )
    usd_amount = (
        F.col("r").cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")
    ).cast("decimal(20,2)")
    local = (usd_amount * F.col("exchange")).cast("decimal(34,8)")
    return (
        daily.join(rates, ["order_date", "currency_code"], "left")
        .groupBy("currency_code", F.year("order_date").alias("year"))
        .agg(
            F.sum(usd_amount).cast("double").alias("revenue_usd"),
            F.round(F.sum(local), 2).cast("double").alias("revenue_local"),
            F.sum(F.when(F.col("exchange").isNull(), F.col("n")).otherwise(0)).alias(
                "lines_without_rate"
            ),
        )
    )
