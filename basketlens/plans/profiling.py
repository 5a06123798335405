"""Profiles of the raw tables, before any cleaning."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.scalars import parse_money, parse_raw_date, percent2, ratio2
from basketlens.operators.distinct import distinct_counts

Raw = Mapping[str, DataFrame]


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


# What identical rows share at least.
ROW_KEYS = {
    "sales": ["Order Number", "Line Item"],
    "customers": ["CustomerKey"],
    "products": ["ProductKey"],
    "stores": ["StoreKey"],
    "exchange_rates": ["Date", "Currency"],
}


def profile_tables(raw: Raw) -> DataFrame:
    """Rows, columns and fully identical surplus rows per table.

    Identical rows share their key, so only rows whose key occurs more than
    once are compared whole; of all others just the key is shuffled.
    """
    parts = []
    for name, df in raw.items():
        keys = ROW_KEYS.get(name, df.columns)
        names = [f"_key{i}" for i in range(len(keys))]
        per_key = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(
            F.count(F.lit(1)).alias("_k")
        )
        repeated = per_key.where("_k > 1").drop("_k")
        same = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
        whole = (
            df.join(repeated, reduce(Column.__and__, same), "left_semi")
            .groupBy(*[F.col(f"`{c}`") for c in df.columns])
            .agg((F.count(F.lit(1)) - 1).alias("_k"))
        )
        surplus = whole.agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("_s")).scalar()
        parts.append(
            per_key.agg(F.coalesce(F.sum("_k"), F.lit(0)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
                surplus.alias("duplicate_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# The columns whose values are listed.
LISTED = [
    ("sales", "Currency Code"), ("products", "Category"), ("customers", "Continent"),
    ("stores", "Country"), ("exchange_rates", "Currency"),
]


def profile_values(raw: Raw) -> DataFrame:
    """A row per value of the columns that should hold few, with its rows."""
    parts = [
        raw[table].groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n_rows")
        for table, column in LISTED
    ]
    return reduce(DataFrame.unionByName, parts)


def profile_columns(raw: Raw) -> DataFrame:
    """Type and missing values per column; one aggregate per table."""
    parts = []
    for name, df in raw.items():
        counts = [
            _count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)
        ]
        totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
        entries = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("data_type"),
                    F.coalesce(F.col(f"m{i}"), F.lit(0)).alias("missing"),
                )
                for i, (c, t) in enumerate(df.dtypes)
            ]
        )
        parts.append(
            totals.select("n_rows", F.inline(entries)).select(
                F.lit(name).alias("table_name"),
                "column_name",
                "data_type",
                "missing",
                F.coalesce(percent2("missing", "n_rows"), F.lit(0.0)).alias("missing_pct"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# The keys of a sales line that are counted.
SALES_KEYS = {
    "order_number": ["Order Number"],
    "order_line": ["Order Number", "Line Item"],
    "customer_key": ["CustomerKey"],
    "product_key": ["ProductKey"],
    "store_key": ["StoreKey"],
    "currency_code": ["Currency Code"],
}


def profile_sales_keys(raw: Raw) -> DataFrame:
    """Distinct keys of the sales table, one row per key, from one pass."""
    counted = distinct_counts(raw["sales"], SALES_KEYS)
    # A row per label, also where the table has no value of it.
    labels = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(0).cast("bigint").alias("n")) for k in SALES_KEYS])
    none = raw["sales"].sparkSession.range(1).select(F.inline(labels))
    every = counted.withColumnRenamed("distinct_values", "n").unionByName(none)
    return every.groupBy(F.col("label").alias("key_name")).agg(F.max("n").alias("distinct_values"))


def profile_order_dates(raw: Raw) -> DataFrame:
    """Range and readability of the two date columns of the sales table."""
    ordered = parse_raw_date("Order Date")
    delivered = parse_raw_date("Delivery Date")
    blank = F.col("Delivery Date").isNull()
    return raw["sales"].agg(
        F.min(ordered).alias("first_order_date"),
        F.max(ordered).alias("last_order_date"),
        _count_if(ordered.isNull()).alias("order_date_unreadable"),
        _count_if(blank).alias("delivery_date_missing"),
        percent2(_count_if(blank), F.count(F.lit(1))).alias("delivery_date_missing_pct"),
        _count_if(~blank & delivered.isNull()).alias("delivery_date_invalid"),
    )


def profile_quantity(raw: Raw) -> DataFrame:
    q = F.col("Quantity")
    return raw["sales"].agg(
        F.min(q).alias("min_quantity"),
        F.max(q).alias("max_quantity"),
        ratio2(F.sum(q), F.count(q)).alias("mean_quantity"),
        _count_if(q <= 0).alias("not_positive"),
    )


def profile_products(raw: Raw) -> DataFrame:
    """Cardinalities, price and cost ranges, unreadable prices, loss makers."""
    products = raw["products"]
    cost, price = parse_money("Unit Cost USD"), parse_money("Unit Price USD")
    ranges = products.agg(
        F.count_distinct("ProductKey").alias("products"),
        F.min(cost).cast("double").alias("min_cost_usd"),
        F.max(cost).cast("double").alias("max_cost_usd"),
        _count_if(cost.isNull()).alias("cost_unreadable"),
        F.min(price).cast("double").alias("min_price_usd"),
        F.max(price).cast("double").alias("max_price_usd"),
        _count_if(price.isNull()).alias("price_unreadable"),
        _count_if(price < cost).alias("price_below_cost"),
    )
    kinds = products.select("Category", "Subcategory", "Brand").distinct().agg(
        F.struct(
            F.count_distinct("Category").alias("categories"),
            F.count_distinct("Subcategory").alias("subcategories"),
            F.count_distinct("Brand").alias("brands"),
        ).alias("k")
    )
    return ranges.withColumn("k", kinds.scalar()).select(*ranges.columns, "k.*")


def profile_customers(raw: Raw) -> DataFrame:
    customers = raw["customers"]
    keys = customers.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("CustomerKey").alias("customers"),
    )
    # Gender, country and continent have small domains; reduce to those first.
    kinds = customers.groupBy("Gender", "Country", "Continent").agg(F.count(F.lit(1)).alias("n"))
    facts = kinds.agg(
        F.struct(
            F.count_distinct("Country").alias("countries"),
            F.count_distinct("Continent").alias("continents"),
            F.sum(F.when(F.col("Gender") == "Female", F.col("n")).otherwise(0)).alias("female"),
            F.sum(F.when(F.col("Gender") == "Male", F.col("n")).otherwise(0)).alias("male"),
        ).alias("k")
    )
    return keys.withColumn("k", facts.scalar()).select(
        "n_rows", "customers", (F.col("n_rows") == F.col("customers")).alias("key_unique"), "k.*"
    )


def profile_gender_counts(raw: Raw) -> DataFrame:
    return raw["customers"].groupBy(F.col("Gender").alias("gender")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def profile_stores(raw: Raw) -> DataFrame:
    """Keys, countries, floor area, and the first five and last three keys."""
    stores = raw["stores"]
    area = F.col("Square Meters")
    keys = stores.select("StoreKey").distinct()
    first = keys.orderBy("StoreKey").limit(5).agg(F.array_sort(F.collect_list("StoreKey")))
    last = keys.orderBy(F.col("StoreKey").desc()).limit(3).agg(
        F.array_sort(F.collect_list("StoreKey"))
    )
    shape = stores.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("StoreKey").alias("stores"),
        F.count_distinct("Country").alias("countries"),
        F.min(area).alias("min_square_meters"),
        F.max(area).alias("max_square_meters"),
        _count_if(area.isNull()).alias("missing_square_meters"),
    )
    return shape.withColumn("f", first.scalar()).withColumn("l", last.scalar()).select(
        *shape.columns,
        F.array_join(F.col("f").cast("array<string>"), ", ").alias("first_keys"),
        F.array_join(F.col("l").cast("array<string>"), ", ").alias("last_keys"),
    )


def profile_fx(raw: Raw) -> DataFrame:
    day = parse_raw_date("Date")
    return raw["exchange_rates"].agg(
        F.min(day).alias("first_rate_date"),
        F.max(day).alias("last_rate_date"),
        F.count_distinct("Currency").alias("currencies"),
    )


REFERENCES = {
    "customer_key": ("CustomerKey", "customers"),
    "product_key": ("ProductKey", "products"),
    "store_key": ("StoreKey", "stores"),
}


def profile_referential(raw: Raw) -> DataFrame:
    """Sales rows whose key is missing in the master table."""
    parts = []
    for label, (key, master) in REFERENCES.items():
        per_key = raw["sales"].groupBy(key).agg(F.count(F.lit(1)).alias("k"))
        lost = per_key.join(raw[master].select(key), key, "left_anti")
        parts.append(
            lost.agg(
                F.coalesce(F.sum("k"), F.lit(0)).alias("orphan_rows"),
                F.count(key).alias("orphan_keys"),
            ).select(F.lit(label).alias("key_name"), "orphan_rows", "orphan_keys")
        )
    return reduce(DataFrame.unionByName, parts)


def profile_currency_gap(raw: Raw) -> DataFrame:
    """A row per currency of the sales table without any exchange rate, with its lines."""
    used = (
        raw["sales"].where(F.col("`Currency Code`").isNotNull())
        .groupBy(F.col("`Currency Code`").alias("currency")).agg(F.count(F.lit(1)).alias("n_lines"))
    )
    known = raw["exchange_rates"].select(F.col("Currency").alias("currency")).distinct()
    return used.join(known, "currency", "left_anti")


def profile_fx_coverage(raw: Raw) -> DataFrame:
    """Do the rates cover the whole span of order dates?"""
    ordered, rated = parse_raw_date("Order Date"), parse_raw_date("Date")
    sales = raw["sales"].agg(F.struct(F.min(ordered).alias("a"), F.max(ordered).alias("b")))
    return raw["exchange_rates"].agg(F.min(rated).alias("ra"), F.max(rated).alias("rb")).withColumn(
        "s", sales.scalar()
    ).select(
        F.col("s.a").alias("first_order_date"),
        F.col("s.b").alias("last_order_date"),
        F.col("ra").alias("first_rate_date"),
        F.col("rb").alias("last_rate_date"),
        ((F.col("ra") <= F.col("s.a")) & (F.col("rb") >= F.col("s.b"))).alias("covered"),
    )


def profile_duplicate_names(raw: Raw) -> DataFrame:
    """Customer names held by more than one key (a name is no identity)."""
    per_name = raw["customers"].groupBy("Name").agg(
        F.count_distinct("CustomerKey").alias("keys")
    )
    shared = per_name.where("keys > 1")
    return shared.agg(
        F.count(F.lit(1)).alias("shared_names"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("customers_sharing"),
    )

