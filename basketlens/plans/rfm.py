"""RFM segmentation of purchasing customers.

Three tables build on each other: base (recency, frequency, monetary), scored,
and segmented. Customers without an order have no RFM values and no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import clip, half_even, percent, percent2, ratio2, usd, usd_per
from basketlens.operators.distribution import Distribution
from basketlens.operators.ranking import equal_groups, global_row_number
from basketlens.sources.staging import stage
from basketlens.sources.star import Star

GROUPS = 5

# Segment names. One row per recency score, best (5) first;
# columns are the combined frequency/monetary score 1 to 5.
SEGMENT_GRID = [
    # R5
    ["New Customers", "Potential Loyalists", "Potential Loyalists", "Loyal Customers", "Champions"],
    # R4
    ["New Customers", "Potential Loyalists", "Loyal Customers", "Loyal Customers", "Champions"],
    # R3
    ["Promising", "Need Attention", "Need Attention", "Loyal Customers", "Loyal Customers"],
    # R2
    ["About To Sleep", "About To Sleep", "At Risk", "At Risk", "Can't Lose Them"],
    # R1
    ["Lost", "Lost", "At Risk", "Can't Lose Them", "Can't Lose Them"],
]

# Segments watched for win-back work.
AT_RISK_SEGMENTS = ["At Risk", "Can't Lose Them", "Lost"]


def segment_name(r_score: Column, fm_score: Column) -> Column:
    rows = [F.array(*[F.lit(name) for name in row]) for row in reversed(SEGMENT_GRID)]
    return F.element_at(F.element_at(F.array(*rows), r_score), fm_score)


def rfm_base(star: Star) -> DataFrame:
    """One row per customer: last order, recency, distinct orders, spend.

    The snapshot is the day after the last order in the data. The table is
    staged: the three scores read it several times in different ways, and the
    sales lines should be read once.
    """
    spend = star.customers("orders", "revenue_cents", "last_date")
    spend = stage(spend.where(F.col("customer_key").isNotNull()), "rfm-base")
    snapshot = spend.agg(F.date_add(F.max("last_date"), 1).alias("d")).scalar()
    return spend.select(
        "customer_key",
        F.col("last_date").alias("last_order_date"),
        F.datediff(snapshot, "last_date").alias("recency_days"),
        F.col("orders").alias("frequency"),
        F.col("revenue_cents").alias("monetary_cents"),
    )


def quantile_bounds(df: DataFrame, value: str, groups: int = GROUPS) -> Column:
    """Scalar array: the order statistic at or below each inner bin edge.

    Coinciding edges are an error: such a column needs a rank instead.
    """
    probs = {f"e{k}": (k, groups) for k in range(groups + 1)}
    edges = Distribution(df, value).quantiles(probs)
    clash = F.size(F.array_distinct(F.array(*probs))) < F.lit(groups + 1)
    lows = F.array(*[f"e{k}_low" for k in range(1, groups)])
    message = F.lit(f"quantile edges of {value} coincide; use a rank")
    return edges.select(
        F.when(clash, F.raise_error(message)).otherwise(lows).alias("bounds")
    ).scalar()


def bin_number(value: str, bounds: str) -> Column:
    """Right-closed quantile bin 1..groups.

    No value lies strictly between the two order statistics around an edge, so
    a value is above the edge exactly if it is above the lower of the two. The
    comparison is therefore free of rounding.
    """
    return F.expr(f"1 + size(filter({bounds}, b -> b < {value}))").cast("int")


def rfm_scores(base: DataFrame) -> DataFrame:
    """Add R, F, M scores (5 is best), the FM blend and the label."""
    # Frequency has few distinct values, so equal groups are cut by rank with
    # ties in customer order.
    ranked = global_row_number(base, "frequency", "customer_key").withColumns(
        {
            "_r_bounds": quantile_bounds(base, "recency_days"),
            "_m_bounds": quantile_bounds(base, "monetary_cents"),
        }
    )
    scored = ranked.select(
        *base.columns,
        (F.lit(GROUPS + 1) - bin_number("recency_days", "_r_bounds")).alias("r_score"),
        equal_groups("row_index", "row_total", GROUPS).alias("f_score"),
        bin_number("monetary_cents", "_m_bounds").alias("m_score"),
    )
    blend = half_even((F.col("f_score") + F.col("m_score")) / F.lit(2.0))
    return scored.withColumns(
        {
            "fm_score": clip(blend.cast("int"), 1, GROUPS),
            "rfm_score_label": F.concat(
                *[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]
            ),
        }
    )


def rfm_segments(star: Star) -> DataFrame:
    """The customer table with scores and segment."""
    scored = rfm_scores(rfm_base(star))
    return scored.select(
        "customer_key", "last_order_date", "recency_days", "frequency",
        "monetary_cents", "r_score", "f_score", "m_score", "fm_score", "rfm_score_label",
        segment_name(F.col("r_score"), F.col("fm_score")).alias("segment"),
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers, revenue and averages per segment with shares of the whole."""
    per_segment = segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("num_customers"),
        F.sum("monetary_cents").alias("r"),
        F.sum("frequency").alias("f"),
        F.sum("recency_days").alias("d"),
    )
    whole = Window.partitionBy()
    n = F.col("num_customers")
    return per_segment.select(
        "segment",
        "num_customers",
        usd("r").alias("total_revenue_usd"),
        usd_per("r", n).alias("avg_monetary_usd"),
        ratio2("f", n).alias("avg_frequency"),
        ratio2("d", n).alias("avg_recency_days"),
        half_even(percent(n, F.sum(n).over(whole)), 2).alias("pct_of_customers"),
        half_even(percent("r", F.sum("r").over(whole)), 2).alias("pct_of_revenue"),
    ).orderBy(F.col("total_revenue_usd").desc(), "segment")


def segment_by(segments: DataFrame, star: Star, attribute: str) -> DataFrame:
    """Customers and revenue per segment and customer attribute, with shares of the segment.

    Both sides have a row per customer. Customers without a master record
    stay, with a null attribute.
    """
    known = segments.join(star.customer_flat(attribute), "customer_key", "left")
    counts = known.groupBy("segment", attribute).agg(
        F.count(F.lit(1)).alias("num_customers"), F.sum("monetary_cents").alias("r")
    )
    per_segment = Window.partitionBy("segment")
    return counts.select(
        "segment",
        attribute,
        "num_customers",
        usd("r").alias("total_revenue_usd"),
        percent2("num_customers", F.sum("num_customers").over(per_segment)).alias(
            "pct_of_segment_customers"
        ),
        percent2("r", F.sum("r").over(per_segment)).alias("pct_of_segment_revenue"),
    )


def segment_last_order_year(segments: DataFrame) -> DataFrame:
    """Where in time each segment's last orders lie."""
    counts = segments.groupBy("segment", F.year("last_order_date").alias("year")).agg(
        F.count(F.lit(1)).alias("num_customers")
    )
    per_segment = Window.partitionBy("segment")
    return counts.withColumn(
        "pct_of_segment",
        percent2("num_customers", F.sum("num_customers").over(per_segment)),
    )


def segment_filtered(segments: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Summary rows of some segments; shares still refer to all customers."""
    wanted = names or AT_RISK_SEGMENTS
    return segment_summary(segments).where(F.col("segment").isin(wanted))
