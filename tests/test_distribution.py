import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators.distribution import QUARTILES, Distribution, guarded_corr

R = random.Random(11)
SERIES = {
    "skewed": [int(R.expovariate(0.001)) for _ in range(900)],
    "tied": [R.choice([1, 2, 2, 2, 5]) for _ in range(301)],
    "hot value": [100] * 400 + [R.randint(0, 1000) for _ in range(800)],
    "constant": [4] * 17,
    "one": [3],
    "two": [3, 8],
}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value bigint")


@pytest.mark.parametrize("name", SERIES)
def test_quantiles_match_linear_interpolation(spark, name):
    values = SERIES[name]
    probs = {"p0": (0, 1), "p20": (1, 5), **QUARTILES, "p95": (19, 20), "p100": (1, 1)}
    got = Distribution(frame(spark, values), "value").quantiles(probs).first()
    assert got["count"] == len(values)
    for q, (num, den) in probs.items():
        assert got[q] == pytest.approx(np.quantile(values, num / den), abs=1e-9)


@pytest.mark.parametrize("name", ["skewed", "tied", "hot value", "two"])
def test_moments(spark, name):
    s = pd.Series(SERIES[name], dtype=float)
    got = Distribution(frame(spark, SERIES[name]), "value").moments().first()
    d = s - s.mean()
    assert got["mean"] == pytest.approx(s.mean())
    assert got["std"] == pytest.approx(s.std())
    assert got["skewness"] == pytest.approx((d**3).mean() / (d**2).mean() ** 1.5, abs=1e-9)
    assert (got["min"], got["max"]) == (s.min(), s.max())


def test_moments_of_constant_have_no_skewness(spark):
    got = Distribution(frame(spark, SERIES["constant"]), "value").moments().first()
    assert got["std"] == 0.0
    assert got["skewness"] is None


def test_grouped_quantiles_and_moments(spark):
    # One group holds most rows; another has one.
    rows = [("a", R.randint(0, 10**6)) for _ in range(1500)]
    rows += [("b", R.randint(0, 50)) for _ in range(60)] + [("c", 7)]
    df = spark.createDataFrame(rows, "g string, value bigint")
    dist = Distribution(df, "value", ["g"])
    quantiles = {r.g: r for r in dist.quantiles(QUARTILES).collect()}
    moments = {r.g: r for r in dist.moments().collect()}
    for g, part in pd.DataFrame(rows, columns=["g", "v"]).groupby("g"):
        assert quantiles[g].q1 == pytest.approx(part.v.quantile(0.25))
        assert quantiles[g].median == pytest.approx(part.v.median())
        assert quantiles[g].q3 == pytest.approx(part.v.quantile(0.75))
        assert moments[g]["mean"] == pytest.approx(part.v.mean())


def test_box_whiskers_stop_inside_the_fences(spark):
    values = [1, 2, 2, 3, 3, 3, 4, 4, 5, 100, -90]
    got = Distribution(frame(spark, values), "value").box().first()
    s = pd.Series(values)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    assert (got.whisker_low, got.whisker_high) == (inside.min(), inside.max())
    assert (got.high_count, got.high_sum, got.low_count) == (1, 100, 1)


def test_mode_takes_the_smallest_on_ties(spark):
    assert Distribution(frame(spark, [5, 5, 2, 2, 9]), "value").mode().first().mode == 2


@pytest.mark.parametrize("values", [SERIES["skewed"], [1, 2, 3, 61], [5, 5, 5]])
def test_histogram_matches_numpy(spark, values):
    got = Distribution(frame(spark, values), "value").histogram(60).orderBy("bin").collect()
    assert len(got) == 60
    assert sum(r.n for r in got) == len(values)
    if min(values) < max(values):
        counts, edges = np.histogram(values, bins=60)
        assert [r.n for r in got] == counts.tolist()
        assert got[0].bin_low == pytest.approx(edges[0])
        assert got[-1].bin_high == pytest.approx(edges[-1])


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(None,), (4,), (6,)], "value bigint")
    assert Distribution(df, "value").moments().first()["count"] == 2


def test_corr_guard(spark):
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert flat.agg(guarded_corr("x", "y").alias("c")).first().c is None
    line = flat.withColumn("y", F.col("x") * -2)
    assert line.agg(guarded_corr("x", "y").alias("c")).first().c == pytest.approx(-1.0)
    assert line.limit(1).agg(guarded_corr("x", "y").alias("c")).first().c is None
