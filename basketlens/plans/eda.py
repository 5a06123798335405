"""Exploratory statistics and the rows behind their charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import DAYS_PER_YEAR, WEEKDAYS, percent2, usd
from basketlens.operators.distribution import (
    MEDIAN,
    Distribution,
    guarded_corr,
    weighted_histogram,
)
from basketlens.sources.star import Star

SKEWED = 0.5
HISTOGRAM_BINS = 60
AGE_BINS = 40


# -- the distributions ---------------------------------------------------------


def order_revenue(star: Star) -> Distribution:
    orders = star.orders("order_number", "revenue_cents").groupBy("order_number").agg(
        F.sum("revenue_cents").alias("revenue_cents")
    )
    return Distribution(orders, "revenue_cents")


def lines_per_order(star: Star) -> Distribution:
    orders = star.orders("order_number", "n_lines").groupBy("order_number").agg(
        F.sum("n_lines").alias("n_lines")
    )
    return Distribution(orders, "n_lines")


def customer_spend(star: Star) -> Distribution:
    return Distribution(star.customers("revenue_cents"), "revenue_cents")


def customer_age(star: Star) -> Distribution:
    """Age in days on the last order date, purchasing customers only."""
    buyers = star.customers()
    people = star.customer_flat("birthday").join(buyers, "customer_key", "left_semi")
    last = star.last_order_date().scalar()
    return Distribution(people, F.datediff(last, "birthday"))


def line_revenue(star: Star) -> Distribution:
    return Distribution(star.line_value_counts("revenue_cents"), "revenue_cents", weight="n")


# -- helpers -------------------------------------------------------------------


def _money4(col: str) -> Column:
    return F.round(F.col(col) / F.lit(100.0), 4)


def _with_median(dist: Distribution) -> DataFrame:
    median = dist.quantiles(MEDIAN).select("median")
    return dist.moments().withColumn("median", median.scalar())


def _spend_stats(dist: Distribution) -> DataFrame:
    # The two shape labels.
    shape = F.when(
        F.col("skewness") > SKEWED, F.lit("right-skewed (long tail of high-value orders)")
    ).otherwise(F.lit("roughly symmetric"))
    return _with_median(dist).select(
        "count",
        _money4("mean").alias("mean_usd"),
        _money4("median").alias("median_usd"),
        _money4("std").alias("std_usd"),
        usd("min").alias("min_usd"),
        usd("max").alias("max_usd"),
        F.round("skewness", 6).alias("skewness"),
        shape.alias("shape"),
    )


def _money_histogram(hist: DataFrame) -> DataFrame:
    return hist.select(
        "bin", _money4("bin_low").alias("bin_low"), _money4("bin_high").alias("bin_high"), "n"
    )


def _money_box(box: DataFrame, *by: str) -> DataFrame:
    return box.select(
        *by,
        _money4("q1").alias("q1_usd"),
        _money4("median").alias("median_usd"),
        _money4("q3").alias("q3_usd"),
        usd("whisker_low").alias("whisker_low_usd"),
        usd("whisker_high").alias("whisker_high_usd"),
        "count",
        "low_count",
        "high_count",
    )


# -- orders --------------------------------------------------------------------


def eda_order_revenue_stats(star: Star) -> DataFrame:
    return _spend_stats(order_revenue(star))


def eda_order_outliers(star: Star) -> DataFrame:
    """Orders above Q3 + 1.5 IQR; only the upper side counts."""
    return order_revenue(star).box().select(
        _money4("upper_fence").alias("upper_fence_usd"),
        F.col("high_count").alias("outlier_orders"),
        percent2("high_count", "count").alias("pct_of_orders"),
        usd("high_sum").alias("outlier_revenue_usd"),
        percent2("high_sum", "sum").alias("pct_of_revenue"),
    )


def eda_hist_order_revenue(star: Star) -> DataFrame:
    return _money_histogram(order_revenue(star).histogram(HISTOGRAM_BINS))


def eda_order_box(star: Star) -> DataFrame:
    return _money_box(order_revenue(star).box())


def eda_lines_per_order(star: Star) -> DataFrame:
    dist = lines_per_order(star)
    return _with_median(dist).withColumn("mode", dist.mode().scalar()).select(
        F.round("mean", 6).alias("mean_lines"),
        F.col("median").alias("median_lines"),
        F.col("max").alias("max_lines"),
        F.col("mode").alias("mode_lines"),
    )


def eda_lines_per_order_dist(star: Star) -> DataFrame:
    return lines_per_order(star).counts.select(
        F.col("v").alias("lines"), F.col("n").alias("orders")
    )


# -- customers -----------------------------------------------------------------


def eda_customer_spend_stats(star: Star) -> DataFrame:
    return _spend_stats(customer_spend(star)).drop("shape")


def eda_hist_customer_spend(star: Star) -> DataFrame:
    """Spend in 60 bins, once on the linear and once on the log10 scale."""
    dist = customer_spend(star)
    linear = _money_histogram(dist.histogram(HISTOGRAM_BINS))
    # log10 has no value at or below zero; such customers show only above.
    log = weighted_histogram(
        dist.counts.where("v > 0"), F.log10(F.col("v") / F.lit(100.0)), HISTOGRAM_BINS
    ).select("bin", F.round("bin_low", 6).alias("bin_low"), F.round("bin_high", 6).alias("bin_high"), "n")
    return linear.select(F.lit("linear").alias("scale"), "*").unionByName(
        log.select(F.lit("log10").alias("scale"), "*")
    )


def eda_customer_age(star: Star) -> DataFrame:
    def years(col: str, name: str) -> Column:
        return F.round(F.col(col) / F.lit(DAYS_PER_YEAR), 6).alias(name)

    return _with_median(customer_age(star)).select(
        "count",
        years("mean", "mean_age"),
        years("median", "median_age"),
        years("std", "std_age"),
        years("min", "min_age"),
        years("max", "max_age"),
    )


def eda_hist_age(star: Star) -> DataFrame:
    def years(col: str) -> Column:
        return F.round(F.col(col) / F.lit(DAYS_PER_YEAR), 6).alias(col)

    return customer_age(star).histogram(AGE_BINS).select(
        "bin", years("bin_low"), years("bin_high"), "n"
    )


def eda_country_revenue(star: Star) -> DataFrame:
    spend = star.customers("revenue_cents").join(
        star.customer_flat("customer_country"), "customer_key"
    )
    return (
        spend.groupBy(F.col("customer_country").alias("country"))
        .agg(F.sum("revenue_cents").alias("r"))
        .select("country", usd("r").alias("total_revenue_usd"))
        .orderBy(F.col("total_revenue_usd").desc(), "country")
    )


# -- products ------------------------------------------------------------------


def _product_scatter(star: Star) -> DataFrame:
    totals = star.product_totals("quantity", "revenue_cents")
    return totals.join(star.product_flat("category_name"), "product_key")


def eda_product_qty_revenue(star: Star) -> DataFrame:
    return _product_scatter(star).select(
        "product_key", "category_name",
        F.col("quantity").alias("total_quantity"),
        usd("revenue_cents").alias("total_revenue_usd"),
    )


def eda_product_qty_revenue_corr(star: Star) -> DataFrame:
    points = _product_scatter(star).select(
        F.col("quantity").cast("double").alias("x"), usd("revenue_cents").alias("y")
    )
    return points.agg(
        F.count(F.lit(1)).alias("products"),
        F.round(guarded_corr("x", "y"), 6).alias("pearson_r"),
    )


def eda_category_line_box(star: Star) -> DataFrame:
    """Box plot of line revenue per category, highest median first."""
    by = ["category_name"]
    dist = Distribution(star.line_value_counts("revenue_cents", by), "revenue_cents", by, "n")
    return _money_box(dist.box(), "category_name").orderBy(
        F.col("median_usd").desc(), "category_name"
    )


def eda_line_outliers(star: Star) -> DataFrame:
    """Upper fence over order lines, and the single largest line."""
    fences = line_revenue(star).box()
    columns = ["order_number", "line_item", "product_key", "quantity", "revenue_cents"]
    largest = (
        star.fact(*columns)
        .orderBy(F.col("revenue_cents").desc_nulls_last(), "order_number", "line_item", "product_key")
        .limit(1)
    )
    named = largest.join(star.product_flat("product_name"), "product_key", "left").select(
        F.struct("quantity", "product_name").alias("m")
    )
    return fences.withColumn("m", named.scalar()).select(
        _money4("upper_fence").alias("upper_fence_usd"),
        F.col("high_count").alias("outlier_lines"),
        percent2("high_count", "count").alias("pct_of_lines"),
        usd("max").alias("max_line_usd"),
        F.col("m.quantity").alias("max_line_quantity"),
        F.col("m.product_name").alias("max_line_product"),
    )


# -- time ----------------------------------------------------------------------


def _monthly(star: Star) -> DataFrame:
    return (
        star.orders("year_month", "year", "month", "revenue_cents")
        .groupBy("year_month", "year", "month")
        .agg(F.sum("revenue_cents").alias("r"))
    )


def eda_monthly_range(star: Star) -> DataFrame:
    """Weakest and strongest month; the earlier one on ties."""
    months = _monthly(star).withColumn("i", F.col("year") * 12 + F.col("month"))
    return months.agg(
        usd(F.min("r")).alias("min_revenue_usd"),
        usd(F.max("r")).alias("max_revenue_usd"),
        F.max_by("year_month", F.struct(F.col("r"), -F.col("i"))).alias("best_month"),
        F.min_by("year_month", F.struct(F.col("r"), F.col("i"))).alias("worst_month"),
    )


def eda_seasonality(star: Star) -> DataFrame:
    """Mean revenue per calendar month: total over full years / number of them.

    The last year counts as partial and is left out. A month absent in some
    year still divides by all years.
    """
    # A few rows per year, so whole-table windows are small.
    whole = Window.partitionBy()
    months = _monthly(star).withColumn("last", F.max("year").over(whole))
    full = months.where("year < last").withColumn(
        "years", F.size(F.collect_set("year").over(whole))
    )
    return (
        full.groupBy("month", "years")
        .agg(F.sum("r").alias("r"))
        .select("month", F.round(usd("r") / F.col("years"), 4).alias("avg_revenue_usd"))
        .orderBy("month")
    )


def eda_weekday_revenue(star: Star) -> DataFrame:
    """Seven rows Monday to Sunday, also for days without sales."""
    sums = star.orders("weekday", "revenue_cents").groupBy("weekday").agg(
        F.sum("revenue_cents").alias("r")
    )
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    week = star.spark.range(1).select(F.posexplode(names).alias("weekday", "day_name"))
    return week.join(sums, "weekday", "left").select(
        "weekday", "day_name", usd("r").alias("total_revenue_usd")
    ).orderBy("weekday")
