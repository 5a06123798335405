"""Exact statistics of one numeric column from its value counts.

Counting equal values is a plain aggregate with map-side combine, so ties and
hot groups shrink before any shuffle. Everything else (moments, quantiles,
mode, histogram, box plot, outliers) reads the counts, never the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import ratio

# Cuts per distribution; looked up in two steps of the square root each.
CUTS = 63
CUT_STEP = 8
CUT_ACCURACY = 4000
# Parts a group is spread over while per-group values are attached to it.
GROUP_PARTS = 64


def approx_cuts(value: str, n: int) -> str:
    """SQL for ``n`` approximate quantiles cutting a column into n + 1 parts."""
    points = ", ".join(f"{i / (n + 1)}D" for i in range(1, n + 1))
    return f"array_distinct(percentile_approx({value}, array({points}), {CUT_ACCURACY}))"


def coarse_cuts(cuts: str, step: int) -> str:
    """SQL for every ``step``-th element of a sorted array."""
    return f"filter({cuts}, (c, i) -> (i + 1) % {step} = 0)"


def cuts_below(cuts: str, coarse: str, step: int, value: str) -> str:
    """SQL counting the elements of a sorted array below a value.

    First over the coarse array, then over the one slice that is left, so a
    row costs about two square roots of the array length. Never null.
    """
    skipped = f"{step} * size(filter({coarse}, c -> c < {value}))"
    rest = f"size(filter(slice({cuts}, {skipped} + 1, {step}), c -> c < {value}))"
    return f"coalesce({skipped} + {rest}, 0)"


class Distribution:
    """Value counts ``(by..., v, n)`` of an integer column, nulls left out."""

    def __init__(
        self,
        df: DataFrame,
        value: Column | str,
        by: list[str] | None = None,
        weight: str | None = None,
    ):
        self.by = list(by or [])
        v = F.col(value) if isinstance(value, str) else value
        # ``weight``: how many rows a row of ``df`` stands for.
        n = F.col(weight) if weight else F.lit(1)
        self.counts = (
            df.select(*self.by, v.cast("bigint").alias("v"), n.cast("bigint").alias("n"))
            .where(F.col("v").isNotNull())
            .groupBy(*self.by, "v")
            .agg(F.sum("n").alias("n"))
        )

    def _attach(self, per_group: DataFrame) -> DataFrame:
        """The counts with the columns of a one-row-per-group frame.

        Without groups that row is a scalar. With groups the few rows are
        repeated so that a group holding much of the data is spread out.
        """
        extra = [c for c in per_group.columns if c not in self.by]
        if not self.by:
            packed = per_group.select(F.struct(*extra).alias("_s"))
            return self.counts.withColumn("_s", packed.scalar()).select("v", "n", "_s.*")
        spread = self.counts.withColumn("_part", F.pmod(F.hash("v"), F.lit(GROUP_PARTS)))
        repeated = per_group.withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1)))
        )
        return self._join_groups(spread, repeated, ["_part"]).drop("_part")

    def _join_groups(self, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        """Inner join on the group and ``keys`` in which a null group is a group.

        A plain equality would also push null filters below the counts, and
        the counts would no longer be one plan that Spark runs once.
        """
        names = [*self.by, *keys]
        renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in names})
        same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in names]
        return left.join(renamed, same).drop(*[f"_right_{c}" for c in names])

    # -- moments -------------------------------------------------------------

    def moments(self) -> DataFrame:
        """count, sum, mean, sample std, min, max, population skewness.

        One row per group. Deviations are taken from the exact mean, so large
        values do not cancel.
        """
        basic = self.counts.groupBy(*self.by).agg(
            ratio(F.sum(F.col("v") * F.col("n")), F.sum("n")).alias("mean")
        )
        centred = self._attach(basic)
        d = F.col("v") - F.col("mean")
        n = F.col("n").cast("double")
        powers = centred.groupBy(*self.by).agg(
            F.sum("n").alias("count"),
            F.sum(F.col("v") * F.col("n")).alias("sum"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
            F.sum(n * d * d).alias("_m2"),
            F.sum(n * d * d * d).alias("_m3"),
        )
        variance = ratio("_m2", "count")
        third = ratio("_m3", "count")
        return powers.select(
            *self.by,
            "count",
            "sum",
            ratio("sum", "count").alias("mean"),
            F.sqrt(ratio("_m2", F.col("count") - 1)).alias("std"),
            "min",
            "max",
            ratio(third, F.pow(variance, F.lit(1.5))).alias("skewness"),
        )

    # -- quantiles -----------------------------------------------------------

    def quantiles(self, probs: dict[str, tuple[int, int]]) -> DataFrame:
        """Linearly interpolated quantiles as doubles, one row per group.

        ``probs`` maps an output name to a fraction (numerator, denominator),
        so positions are computed in integers. The output also carries
        ``<name>_low``, the order statistic at or below the position.
        """
        cuts = (
            self.counts.groupBy(*self.by)
            .agg(F.expr(approx_cuts("v", CUTS)).alias("_c"), F.sum("n").alias("_total"))
            .selectExpr(*self.by, "_c", f"{coarse_cuts('_c', CUT_STEP)} AS _d", "_total")
        )
        ranged = self._attach(cuts).selectExpr(
            *self.by, "v", "n", "_total", f"{cuts_below('_c', '_d', CUT_STEP, 'v')} AS _range"
        )
        # One row per range; a group has at most CUTS + 1 of them.
        upto = Window.partitionBy(*self.by).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        ranges = (
            ranged.groupBy(*self.by, "_range", "_total")
            .agg(F.sum("n").alias("_size"))
            .withColumn("_start", F.coalesce(F.sum("_size").over(upto), F.lit(0)))
        )
        # Position (0-based, in integers) at or below the quantile, and the
        # next one if the quantile falls between two.
        low = {q: f"((_total - 1) * {num} DIV {den})" for q, (num, den) in probs.items()}
        rest = {q: f"((_total - 1) * {num} % {den})" for q, (num, den) in probs.items()}
        high = {q: f"({low[q]} + if({rest[q]} > 0, 1, 0))" for q in probs}
        hits = [
            f"{p} >= _start AND {p} < _start + _size" for p in [*low.values(), *high.values()]
        ]
        # Only ranges that hold a wanted position are sorted.
        kept = ranges.where(" OR ".join(hits)).select(*self.by, "_range", "_start")
        if not self.by:
            # At most two ranges per quantile, so other rows drop out before
            # the shuffle. With groups the size is for the optimizer to judge.
            kept = F.broadcast(kept)
        inside = (
            Window.partitionBy(*self.by, "_range")
            .orderBy("v")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        placed = self._join_groups(ranged, kept, ["_range"]).withColumn(
            "_end", F.col("_start") + F.sum("n").over(inside)
        )
        bounds = []
        for q in probs:
            bounds.append(F.expr(f"min(if(_end > {low[q]}, v, NULL)) AS {q}_low"))
            bounds.append(F.expr(f"min(if(_end > {high[q]}, v, NULL)) AS _{q}_high"))
        found = placed.groupBy(*self.by, "_total").agg(*bounds)
        out = []
        for q, (_, den) in probs.items():
            step = f"({rest[q]} / CAST({den} AS DOUBLE))"
            out.append(f"CAST({q}_low + (_{q}_high - {q}_low) * {step} AS DOUBLE) AS {q}")
            out.append(f"{q}_low")
        return found.selectExpr(*self.by, "_total AS count", *out)

    # -- shapes --------------------------------------------------------------

    def mode(self) -> DataFrame:
        """Most frequent value, the smallest on ties."""
        return self.counts.groupBy(*self.by).agg(
            F.max_by("v", F.struct(F.col("n"), -F.col("v"))).alias("mode")
        )

    def box(self) -> DataFrame:
        """Quartiles, fences at 1.5 IQR, whiskers and outlier totals."""
        quartiles = self.quantiles(QUARTILES).select(*self.by, "q1", "median", "q3")
        iqr = F.col("q3") - F.col("q1")
        fenced = quartiles.withColumn("lower_fence", F.col("q1") - 1.5 * iqr).withColumn(
            "upper_fence", F.col("q3") + 1.5 * iqr
        )
        names = ["q1", "median", "q3", "lower_fence", "upper_fence"]
        joined = self._attach(fenced)
        v, n = F.col("v"), F.col("n")
        high = v > F.col("upper_fence")
        low = v < F.col("lower_fence")
        return joined.groupBy(*self.by, *names).agg(
            F.min(F.when(~low, v)).alias("whisker_low"),
            F.max(F.when(~high, v)).alias("whisker_high"),
            F.max(v).alias("max"),
            F.sum(n).alias("count"),
            F.sum(v * n).alias("sum"),
            F.sum(F.when(high, n).otherwise(0)).alias("high_count"),
            F.sum(F.when(high, v * n).otherwise(0)).alias("high_sum"),
            F.sum(F.when(low, n).otherwise(0)).alias("low_count"),
        )

    def histogram(self, bins: int) -> DataFrame:
        """Equal-width bins from min to max, empty bins included.

        The last bin is closed on the right. Bin numbers are integer
        arithmetic, so a value on an edge lands in the same bin everywhere.
        """
        if self.by:
            raise ValueError("histograms are built for one distribution at a time")
        span = self.counts.agg(
            F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("span")
        ).where(F.col("span.lo").isNotNull())
        width = F.greatest(F.col("s.hi") - F.col("s.lo"), F.lit(1))
        index = F.least(
            F.floor((F.col("v") - F.col("s.lo")) * bins / width), F.lit(bins - 1)
        ).cast("int")
        filled = (
            self.counts.withColumn("s", span.scalar())
            .groupBy(index.alias("bin"))
            .agg(F.sum("n").alias("n"))
        )
        step = (F.col("span.hi") - F.col("span.lo")).cast("double") / F.lit(float(bins))
        grid = span.select("span", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        return grid.join(filled, "bin", "left").select(
            "bin",
            (F.col("span.lo") + F.col("bin") * step).alias("bin_low"),
            (F.col("span.lo") + (F.col("bin") + 1) * step).alias("bin_high"),
            F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        )


QUARTILES = {"q1": (1, 4), "median": (1, 2), "q3": (3, 4)}
MEDIAN = {"median": (1, 2)}


def weighted_histogram(
    counts: DataFrame, value: Column, bins: int
) -> DataFrame:
    """Histogram of a transformed value (a double) over ``(v, n)`` counts."""
    points = counts.select(value.alias("x"), "n").where(F.col("x").isNotNull())
    span = points.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("span")).where(
        F.col("span.lo").isNotNull()
    )
    width = (F.col("s.hi") - F.col("s.lo")) / F.lit(float(bins))
    index = F.least(
        F.floor(ratio(F.col("x") - F.col("s.lo"), width)), F.lit(bins - 1)
    ).cast("int")
    filled = (
        points.withColumn("s", span.scalar())
        .groupBy(F.coalesce(index, F.lit(0)).alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    step = (F.col("span.hi") - F.col("span.lo")) / F.lit(float(bins))
    grid = span.select("span", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(filled, "bin", "left").select(
        "bin",
        (F.col("span.lo") + F.col("bin") * step).alias("bin_low"),
        (F.col("span.lo") + (F.col("bin") + 1) * step).alias("bin_high"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation; null when a side is constant or has one point."""
    return F.try_divide(
        F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)
    )
