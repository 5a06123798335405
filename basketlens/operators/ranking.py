"""Exact global ranks without sorting everything in one task.

Approximate quantiles of the sort value cut the rows into ranges. They only
steer the load: inside a range rows are numbered exactly, and each range
starts where the ranges before it end. Rows that sit on a cut value may be a
large tie, so they form ranges of their own, cut again by the unique key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.distribution import approx_cuts, coarse_cuts, cuts_below

VALUE_CUTS = 255
KEY_CUTS = 63
CUT_STEP = 16

# Range numbers whose order agrees with (value, key). A value equal to a cut
# gets ranges of its own, numbered along the key.
_RANGE = """struct(
  {below_value} AS a,
  coalesce(array_contains(_cuts._v, {value}), false) AS b,
  if(coalesce(array_contains(_cuts._v, {value}), false), {below_key}, 0) AS c)"""


def global_row_number(
    df: DataFrame,
    value: str,
    key: str,
    name: str = "row_index",
    total: str = "row_total",
    value_cuts: int = VALUE_CUTS,
    key_cuts: int = KEY_CUTS,
) -> DataFrame:
    """Add the 0-based position in (value, key) order and the row count.

    ``value`` must be numeric and ``key`` a numeric unique key; for descending
    order pass a negated value.
    """
    cuts = df.agg(
        F.expr(approx_cuts(value, value_cuts)).alias("_v"),
        F.expr(approx_cuts(key, key_cuts)).alias("_k"),
    ).selectExpr(
        f"struct(_v, {coarse_cuts('_v', CUT_STEP)} AS _vd, "
        f"_k, {coarse_cuts('_k', CUT_STEP)} AS _kd) AS cuts"
    )
    range_id = _RANGE.format(
        value=value,
        below_value=cuts_below("_cuts._v", "_cuts._vd", CUT_STEP, value),
        below_key=cuts_below("_cuts._k", "_cuts._kd", CUT_STEP, key),
    )
    ranged = (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn("_range", F.expr(range_id))
        .drop("_cuts")
    )
    # At most value_cuts * (key_cuts + 2) + 1 ranges, so one task can add up.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_range",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
            F.sum("_n").over(Window.partitionBy()).alias(total),
        )
    )
    inside = Window.partitionBy("_range").orderBy(F.col(value), F.col(key))
    return (
        ranged.withColumn("_pos", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_range", "_pos", "_start")
    )


_NTILE = """1 + if({i} < {n} % {t} * ({n} DIV {t} + 1),
  {i} DIV ({n} DIV {t} + 1),
  {n} % {t} + ({i} - {n} % {t} * ({n} DIV {t} + 1)) DIV greatest({n} DIV {t}, 1))"""


def ntile_of(index: str, total: str, tiles: int) -> Column:
    """NTILE number of a 0-based position: the first tiles get one row more."""
    return F.expr(_NTILE.format(i=index, n=total, t=tiles)).cast("int")


def equal_groups(index: str, total: str, groups: int) -> Column:
    """Quantile group (1..groups) of a unique 0-based rank.

    Right-closed bins with linearly interpolated edges over the ranks, in
    integers only. It is not NTILE: the two differ when ``total`` is no
    multiple of ``groups``.
    """
    above = [f"if({index} * {groups} > ({total} - 1) * {k}, 1, 0)" for k in range(1, groups)]
    return F.expr(f"1 + {' + '.join(above)}").cast("int")


def top_k(
    df: DataFrame,
    k: int,
    value: str,
    keys: list[str],
    rank: str | None = None,
    ascending: bool = False,
) -> DataFrame:
    """First ``k`` rows by value with a unique tie-break, optionally ranked.

    The sort keeps k rows per task. Ranking those k rows equals ranking all
    rows: whatever outranks a kept row is kept too.
    """
    by = F.col(value).asc() if ascending else F.col(value).desc()
    best = df.orderBy(by, *keys).limit(k)
    if rank is None:
        return best
    return best.withColumn(rank, F.rank().over(Window.orderBy(by)))
