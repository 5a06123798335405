"""Query catalogue: key -> plan over a folder of source tables, plus check SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.scalars import parse_money, parse_raw_date
from basketlens.oracles.analytics_sql import (
    cohort_oracles,
    eda_oracles,
    measure_oracles,
    rfm_oracles,
)
from basketlens.oracles.sales_sql import customer_oracles, sales_oracles
from basketlens.oracles.tables_sql import cleaning_oracles, profile_oracles, quality_oracles
from basketlens.plans import (
    cleaning,
    cohorts,
    customers,
    dashboard,
    eda,
    measures,
    profiling,
    quality,
    rfm,
    sales,
)
from basketlens.session import apply_recommended
from basketlens.sources import raw_text
from basketlens.sources.mapped import MappedStar
from basketlens.sources.star import fixed_calendar

Query = Callable[[SparkSession, str], DataFrame]

SALES = [
    sales.kpi_summary, sales.monthly_revenue_and_growth, sales.yearly_revenue_and_growth,
    sales.top_10_products_by_revenue, sales.top_10_products_by_quantity,
    sales.bottom_10_products_by_revenue, sales.products_never_sold, sales.category_revenue,
    sales.category_growth_yoy, sales.product_profitability_top10,
    sales.category_profit_margin, sales.revenue_by_customer_country,
    sales.revenue_by_customer_state_top15, sales.revenue_by_channel,
    sales.revenue_by_store_country,
]
CUSTOMERS = [
    customers.customers_with_zero_orders, customers.repeat_vs_onetime_customers,
    customers.revenue_contribution_repeat_vs_onetime,
    customers.purchase_frequency_distribution, customers.top_20_customers_by_revenue,
    customers.revenue_concentration_deciles, customers.new_customers_per_year,
    customers.avg_spend_and_frequency_by_country, customers.customer_lifespan_summary,
]
PROFILES = [
    profiling.profile_tables, profiling.profile_columns, profiling.profile_sales_keys,
    profiling.profile_order_dates, profiling.profile_quantity, profiling.profile_products,
    profiling.profile_customers, profiling.profile_gender_counts, profiling.profile_stores,
    profiling.profile_fx, profiling.profile_referential, profiling.profile_currency_gap,
    profiling.profile_fx_coverage, profiling.profile_values, profiling.profile_duplicate_names,
]
CHECKS = [
    quality.dup_transaction_key, quality.price_valid, quality.cost_valid,
    quality.category_key_1to1, quality.customer_key_unique, quality.orphan_customer,
    quality.order_has_lines, quality.total_revenue_positive, quality.primary_keys,
    quality.fact_composite_key, quality.foreign_keys, quality.duplicate_groups,
    quality.slice_reconciliation, quality.clean_suite,
]

EDA = [
    eda.eda_order_revenue_stats, eda.eda_order_outliers, eda.eda_lines_per_order,
    eda.eda_lines_per_order_dist, eda.eda_customer_spend_stats, eda.eda_product_qty_revenue,
    eda.eda_product_qty_revenue_corr, eda.eda_monthly_range, eda.eda_seasonality,
    eda.eda_weekday_revenue, eda.eda_category_line_box, eda.eda_country_revenue,
    eda.eda_customer_age, eda.eda_line_outliers, eda.eda_hist_order_revenue,
    eda.eda_hist_customer_spend, eda.eda_hist_age, eda.eda_order_box,
]
GRID_PLANS = [
    cohorts.cohort_retention_pct, cohorts.cohort_matrix, cohorts.cohort_pct_matrix,
    cohorts.cohort_avg_retention, cohorts.cohort_curve, cohorts.cohort_month1,
    cohorts.cohort_month1_stats, cohorts.cohort_month1_trend, cohorts.cohort_size_range,
    cohorts.cohort_month1_large, cohorts.cohort_zoom_12,
]
DASHBOARD = [
    dashboard.weekday_channel_orders, dashboard.product_margin_tiers,
    dashboard.bottom_half_revenue_share, dashboard.top_customer_share,
    dashboard.new_vs_returning_by_year, dashboard.drill_category, dashboard.drill_date,
    dashboard.trend_tooltip,
]

StarPlan = Callable[[MappedStar], DataFrame]


def _on_star(plan: StarPlan) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(MappedStar(apply_recommended(spark), sf_dir))

    return run


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimals leave the catalogue as doubles."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
          for c, t in df.dtypes]
    )


# -- cleaning ------------------------------------------------------------------


def _parse_money(star: MappedStar) -> DataFrame:
    return raw_text.raw_products(star).select(
        F.col("ProductKey").alias("product_key"),
        F.col("Unit Price USD").alias("price_text"),
        parse_money("Unit Price USD").cast("double").alias("unit_price_usd"),
        parse_money("Unit Cost USD").cast("double").alias("unit_cost_usd"),
    )


def _parse_dates(star: MappedStar) -> DataFrame:
    texts = raw_text.raw_sales(star).groupBy(F.col("Order Date").alias("date_text")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return texts.withColumn("parsed_date", parse_raw_date("date_text"))


def _clean_sales(star: MappedStar) -> DataFrame:
    products = cleaning.clean_products(raw_text.raw_products(star))
    return cleaning.clean_sales(raw_text.raw_sales(star), products)


def fixed_dates(star: MappedStar, first: str, last: str) -> DataFrame:
    """Calendar over a given span, with the order lines of each day and those
    before and after the span."""
    days = fixed_calendar(star.spark, first, last)
    daily = star.orders("order_date", "n_lines").groupBy(
        F.col("order_date").alias("date_key")
    ).agg(F.sum("n_lines").alias("n_lines"))
    outside = [
        daily.where(missed).agg(F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n")).scalar().alias(name)
        for name, missed in (
            ("lines_before", F.col("date_key") < F.lit(first).cast("date")),
            ("lines_after", F.col("date_key") > F.lit(last).cast("date")),
        )
    ]
    counted = days.join(daily, "date_key", "left")
    return counted.withColumn("n_lines", F.coalesce("n_lines", F.lit(0))).select("*", *outside)


CLEANING: dict[str, StarPlan] = {
    "clean_parse_money": _parse_money,
    "clean_parse_dates": _parse_dates,
    "clean_customers": lambda s: cleaning.clean_customers(raw_text.raw_customers(s)),
    "clean_products": lambda s: money_as_double(
        cleaning.clean_products(raw_text.raw_products(s))
    ),
    "clean_store_channel": lambda s: cleaning.clean_stores(raw_text.raw_stores(s)),
    "clean_exchange_rates": lambda s: money_as_double(
        cleaning.clean_exchange_rates(raw_text.raw_exchange_rates(s))
    ),
    "clean_sales_enriched": lambda s: money_as_double(_clean_sales(s)),
    "dim_category": lambda s: s.table("dim_category"),
    "dim_subcategory": lambda s: s.table("dim_subcategory"),
    "dim_product": lambda s: money_as_double(s.table("dim_product")),
    "dim_customer": lambda s: s.table("dim_customer"),
    "dim_store": lambda s: s.table("dim_store"),
    "dim_date": lambda s: s.table("dim_date"),
    "dim_date_fixed": lambda s: fixed_dates(s, "1995-01-01", "2001-12-31"),
    "fact_sales_build": lambda s: money_as_double(s.table("fact_sales")),
    "exchange_rate": lambda s: money_as_double(s.table("exchange_rate")),
    "revenue_local_currency": cleaning.revenue_local_currency,
}


# -- quality -------------------------------------------------------------------


def _row_check(name: str) -> StarPlan:
    return lambda s: quality.row_checks(s, [name])


QUALITY: dict[str, StarPlan] = {
    **{f"dq_{c.__name__}": c for c in CHECKS},
    **{f"dq_{n}": _row_check(n) for n in quality.ROW_CHECKS},
    "dq_unreadable_cells": lambda s: quality.unreadable_cells(raw_text.raw_cells(s)),
    "dq_row_counts": lambda s: quality.row_counts(s, raw_text.RawTables(s)),
    "dq_revenue_reconciles": lambda s: quality.revenue_reconciles(s, _clean_sales(s)),
    "dq_star_suite": lambda s: quality.star_suite(s, raw_text.RawTables(s)),
}


def _on_raw(plan: Callable[[Mapping[str, DataFrame]], DataFrame]) -> StarPlan:
    return lambda s: plan(raw_text.RawTables(s))


# -- segments, cohorts, measures -------------------------------------------------

RFM: dict[str, StarPlan] = {
    "rfm_base": rfm.rfm_base,
    "rfm_scores": lambda s: rfm.rfm_scores(rfm.rfm_base(s)),
    "rfm_segments": rfm.rfm_segments,
    "rfm_segment_summary": lambda s: rfm.segment_summary(rfm.rfm_segments(s)),
    "rfm_segment_by_country": lambda s: rfm.segment_by(
        rfm.rfm_segments(s), s, "customer_country"
    ),
    "rfm_segment_by_continent": lambda s: rfm.segment_by(rfm.rfm_segments(s), s, "continent"),
    "rfm_segment_last_order_year": lambda s: rfm.segment_last_order_year(rfm.rfm_segments(s)),
    "segment_filtered": lambda s: rfm.segment_filtered(rfm.rfm_segments(s)),
    "dashboard_implicit_totals": lambda s: dashboard.implicit_totals(s, rfm.rfm_base(s)),
}


def _grid(star: MappedStar) -> DataFrame:
    return cohorts.cohort_grid(cohorts.cohort_active(star))


def _on_grid(plan: Callable[[DataFrame], DataFrame]) -> StarPlan:
    return lambda s: plan(_grid(s))


COHORTS: dict[str, StarPlan] = {
    "cohort_assign": cohorts.cohort_assign,
    "cohort_active": lambda s: cohorts.cohort_active(s).select(
        cohorts.month_of_index("cohort").alias("cohort_month"), "period_number", "active"
    ),
    "cohort_grid": lambda s: _grid(s).drop("cohort"),
    **{p.__name__: _on_grid(p) for p in GRID_PLANS},
    "m_month1_retention": _on_grid(cohorts.month1_retention),
}


def _measure(names: list[str], dims: list[str]) -> StarPlan:
    return lambda s: measures.measures_by(s, names, dims)


MEASURES: dict[str, StarPlan] = {
    "m_total_revenue": _measure(["total_revenue"], ["year", "category_name"]),
    "m_total_orders": _measure(["total_orders"], ["year", "channel"]),
    "m_total_customers": _measure(["total_customers"], ["customer_country"]),
    "m_units_sold": _measure(["units_sold"], ["year", "quarter", "category_name"]),
    "m_average_order_value": _measure(
        ["average_order_value", "median_order_value"], ["year", "channel"]
    ),
    "m_revenue_per_customer": _measure(["revenue_per_customer"], ["continent"]),
    "m_historical_clv": _measure(["historical_clv"], ["customer_state"]),
    "m_revenue_yoy": _measure(["revenue_yoy_growth_pct"], ["year", "month"]),
    "m_revenue_yoy_to_calendar_end": lambda s: measures.measures_by(
        s, ["revenue_yoy_growth_pct", "yoy_period_complete"], ["year"], calendar_end="2001-12-31"
    ),
    "m_repeat_customers": _measure(
        ["repeat_customers", "repeat_customers_in_context"], ["year"]
    ),
    "m_repeat_purchase_rate": _measure(["repeat_purchase_rate_pct"], ["customer_country"]),
    "m_new_customers": _measure(["new_customers"], ["year", "customer_country"]),
    "m_revenue_by_segment": lambda s: measures.measures_by(
        s.with_segments(rfm.rfm_segments(s)),
        ["total_revenue", "total_orders", "total_customers", "repeat_customers"],
        ["segment", "year"],
        {"segment": ["Champions", "Loyal Customers", "At Risk", "Lost"]},
    ),
    "sliced_kpis": lambda s: dashboard.sliced_kpis(
        s,
        ["year", "channel"],
        {"category_name": ["ECONOMY", "PROMO"], "continent": "EUROPE"},
    ),
}

PLANS: dict[str, StarPlan] = {
    **{p.__name__: p for p in [*SALES, *CUSTOMERS]},
    **CLEANING,
    **QUALITY,
    **{p.__name__: _on_raw(p) for p in PROFILES},
    **RFM,
    **COHORTS,
    **{p.__name__: p for p in [*EDA, *DASHBOARD]},
    **MEASURES,
}


def catalogue() -> dict[str, Query]:
    return {name: _on_star(plan) for name, plan in PLANS.items()}


def check_sql() -> dict[str, str]:
    return {
        **sales_oracles(),
        **customer_oracles(),
        **cleaning_oracles(),
        **quality_oracles(),
        **profile_oracles(),
        **rfm_oracles(),
        **cohort_oracles(),
        **eda_oracles(),
        **measure_oracles(),
    }
