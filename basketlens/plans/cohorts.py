"""Monthly acquisition cohorts and their retention.

Months are month numbers inside the plans. From the (cohort, period) counts on
every table is bounded by the square of the number of months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import half_even, month_index, month_of_index, percent
from basketlens.operators.distribution import guarded_corr
from basketlens.sources.staging import stage
from basketlens.sources.star import Star

LARGE_COHORT = 100
ZOOM_PERIODS = 12
NO_TREND = 0.3


def cohort_assign(star: Star) -> DataFrame:
    """Every order with its customer's first month and the months since."""
    orders = star.orders("customer_key", "order_number", "order_date").distinct()
    first = star.customers("first_date")
    joined = star.look_up(orders, first, "customer_key")
    period = month_index("order_date") - month_index("first_date")
    return joined.select(
        "customer_key",
        "order_number",
        "order_date",
        F.trunc("order_date", "MM").alias("order_month"),
        F.trunc("first_date", "MM").alias("cohort_month"),
        period.alias("period_number"),
    )


def cohort_active(star: Star) -> DataFrame:
    """Distinct customers per (cohort, period): ``cohort, period_number, active``.

    A customer's orders collapse to the set of months ordered in, which is
    bounded by the calendar, so even a customer with a third of all orders is
    one small row after the map side.
    """
    months = (
        star.orders("customer_key", "month_index")
        .where("customer_key IS NOT NULL AND month_index IS NOT NULL")
        .groupBy("customer_key")
        .agg(F.collect_set("month_index").alias("months"))
    )
    cohort = F.array_min("months")
    return (
        months.select(cohort.alias("cohort"), F.explode("months").alias("month"))
        .groupBy("cohort", (F.col("month") - F.col("cohort")).alias("period_number"))
        .agg(F.count(F.lit(1)).alias("active"))
    )


def cohort_grid(active: DataFrame) -> DataFrame:
    """All reachable cells, with 0 where a reached month saw nobody return.

    A period is reachable if it ends no later than the last month with an
    order, and no period beyond the largest observed one is shown. Cells that
    are not reached have no row: unknown is not zero.
    """
    whole = Window.partitionBy()
    bounded = active.withColumns(
        {
            "_last": F.max(F.col("cohort") + F.col("period_number")).over(whole),
            "_deepest": F.max("period_number").over(whole),
        }
    )
    per_cohort = bounded.groupBy("cohort", "_last", "_deepest").agg(
        F.max(F.when(F.col("period_number") == 0, F.col("active"))).alias("cohort_size"),
        F.map_from_entries(
            F.collect_list(F.struct("period_number", "active"))
        ).alias("_cells"),
    )
    depth = F.least(F.col("_last") - F.col("cohort"), F.col("_deepest"))
    cells = per_cohort.select(
        "cohort",
        "cohort_size",
        "_cells",
        F.explode(F.sequence(F.lit(0), depth)).alias("period_number"),
    )
    return cells.select(
        "cohort",
        month_of_index("cohort").alias("cohort_month"),
        "cohort_size",
        "period_number",
        F.coalesce(F.try_element_at("_cells", F.col("period_number")), F.lit(0)).alias(
            "active_customers"
        ),
    )


def _pct() -> Column:
    """Unrounded percent of the cohort; rounding belongs to the output."""
    return percent("active_customers", "cohort_size")


def cohort_retention_pct(grid: DataFrame) -> DataFrame:
    return grid.select(
        "cohort_month", "cohort_size", "period_number", "active_customers",
        half_even(_pct(), 2).alias("retention_pct"),
    )


def cohort_matrix(grid: DataFrame, value: Column | None = None) -> DataFrame:
    """Cohorts down, periods across; an unreached cell is null.

    The column list comes from one number, the deepest period of the grid. The
    grid (cohorts times periods) is staged, so the orders are read once.
    """
    grid = stage(grid, "cohort-grid")
    deepest = grid.agg(F.max("period_number")).first()[0]
    periods = list(range(0, (deepest if deepest is not None else -1) + 1))
    cell = F.col("active_customers") if value is None else value
    wide = (
        grid.select("cohort_month", "period_number", cell.alias("cell"))
        .groupBy("cohort_month")
        .pivot("period_number", periods)
        .agg(F.first("cell"))
    )
    return wide.select("cohort_month", *[F.col(f"`{p}`").alias(f"period_{p}") for p in periods])


def cohort_pct_matrix(grid: DataFrame) -> DataFrame:
    return cohort_matrix(grid, half_even(_pct(), 2))


def cohort_avg_retention(grid: DataFrame) -> DataFrame:
    """Mean percent per period over the cohorts old enough to reach it."""
    return grid.groupBy("period_number").agg(
        F.round(F.avg(_pct()), 6).alias("avg_retention_pct"),
        F.count(F.lit(1)).alias("cohorts_averaged"),
    )


def cohort_curve(grid: DataFrame) -> DataFrame:
    """Retention curve without period 0, which is 100 % by definition."""
    return cohort_avg_retention(grid).where("period_number > 0")


def _month1(grid: DataFrame) -> DataFrame:
    return grid.where("period_number = 1").withColumn("pct", _pct())


def cohort_month1(grid: DataFrame) -> DataFrame:
    return _month1(grid).select(
        "cohort_month", "cohort_size", F.round("pct", 6).alias("month1_pct")
    )


def _best_and_worst() -> list[Column]:
    # On ties the earlier cohort wins both ways.
    best = F.max_by("cohort_month", F.struct(F.col("pct"), -F.col("cohort")))
    worst = F.min_by("cohort_month", F.struct(F.col("pct"), F.col("cohort")))
    return [
        best.alias("best_cohort"),
        F.round(F.max("pct"), 6).alias("best_pct"),
        worst.alias("worst_cohort"),
        F.round(F.min("pct"), 6).alias("worst_pct"),
    ]


def cohort_month1_stats(grid: DataFrame) -> DataFrame:
    return _month1(grid).agg(
        F.count(F.lit(1)).alias("cohorts"),
        F.round(F.avg("pct"), 6).alias("mean_pct"),
        F.round(F.stddev_samp("pct"), 6).alias("std_pct"),
        *_best_and_worst(),
    )


def cohort_month1_large(grid: DataFrame, min_size: int = LARGE_COHORT) -> DataFrame:
    """Best and worst Month-1 retention among cohorts of some size."""
    large = _month1(grid).where(F.col("cohort_size") >= min_size)
    return large.agg(F.count(F.lit(1)).alias("cohorts"), *_best_and_worst())


def cohort_month1_trend(grid: DataFrame) -> DataFrame:
    """Correlation of Month-1 retention with the order of the cohorts."""
    # One row per month.
    x = F.row_number().over(Window.orderBy("cohort")) - 1
    series = _month1(grid).withColumn("x", x.cast("double"))
    stats = series.agg(F.count(F.lit(1)).alias("cohorts"), guarded_corr("x", "pct").alias("c"))
    c = F.when(F.col("cohorts") > 2, F.col("c"))
    # The three trend labels.
    label = (
        F.when(F.abs(c) < NO_TREND, F.lit("weak/no trend"))
        .when(c > 0, F.lit("improving over time"))
        .when(c < 0, F.lit("declining over time"))
    )
    return stats.select(
        "cohorts", F.round(c, 6).alias("trend_correlation"), label.alias("trend")
    )


def cohort_size_range(grid: DataFrame) -> DataFrame:
    sizes = grid.where("period_number = 0")
    return sizes.agg(
        F.count(F.lit(1)).alias("cohorts"),
        F.min("cohort_month").alias("first_cohort"),
        F.max("cohort_month").alias("last_cohort"),
        F.min("cohort_size").alias("min_size"),
        F.max("cohort_size").alias("max_size"),
    )


def cohort_zoom_12(grid: DataFrame, periods: int = ZOOM_PERIODS) -> DataFrame:
    """The first year of every cohort, with the colour ceiling of the full grid."""
    ceiling = F.max(F.when(F.col("period_number") >= 1, _pct())).over(Window.partitionBy())
    return (
        grid.withColumn("ceiling", ceiling)
        .where(F.col("period_number") <= periods)
        .select(
            "cohort_month", "period_number", half_even(_pct(), 2).alias("retention_pct"),
            F.round("ceiling", 6).alias("color_ceiling_pct"),
        )
    )


def month1_retention(grid: DataFrame) -> DataFrame:
    """The headline retention KPI: mean Month-1 percent, one row."""
    return _month1(grid).agg(
        F.round(F.avg("pct"), 6).alias("month1_retention_pct"),
        F.count(F.lit(1)).alias("cohorts_averaged"),
    )
