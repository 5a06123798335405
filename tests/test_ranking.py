import random

import pandas as pd
import pytest

from basketlens.operators.ranking import equal_groups, global_row_number, ntile_of, top_k


def frame(spark, values):
    # Keys in an order unrelated to the values.
    keys = list(range(len(values)))
    random.Random(3).shuffle(keys)
    return spark.createDataFrame(list(zip(keys, values)), "key bigint, value bigint")


def expected(df):
    pdf = df.toPandas().sort_values(["value", "key"]).reset_index(drop=True)
    return {int(k): i for i, k in enumerate(pdf.key)}


SERIES = {
    "unique": list(range(1500)),
    "few values": [random.Random(1).randint(1, 4) for _ in range(1500)],
    "a third tied": [7] * 500 + [random.Random(2).randint(0, 9999) for _ in range(1000)],
    "all tied": [5] * 300,
    "negative": [-i * i for i in range(400)],
    "single": [9],
}


@pytest.mark.parametrize("name", SERIES)
def test_global_row_number_is_exact(spark, name):
    df = frame(spark, SERIES[name]).repartition(4)
    ranked = global_row_number(df, "value", "key", value_cuts=15, key_cuts=7).toPandas()
    assert dict(zip(ranked.key, ranked.row_index)) == expected(df)
    assert set(ranked.row_total) == {len(SERIES[name])}


def test_hot_tie_is_cut_into_several_ranges(spark):
    """No task sorts a large tie: the tied rows fall into many window groups."""
    df = frame(spark, [1] * 2000 + list(range(2, 1002)))
    plan = global_row_number(df, "value", "key", value_cuts=15, key_cuts=15)
    from basketlens.operators import ranking

    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in text
    cuts = df.selectExpr(
        f"{ranking.approx_cuts('value', 15)} AS v", f"{ranking.approx_cuts('key', 15)} AS k"
    )
    assert 1 in cuts.first().v
    assert len(cuts.first().k) > 10


@pytest.mark.parametrize("n", [3, 7, 10, 23, 100, 1007])
def test_ntile(spark, n):
    df = spark.range(n).selectExpr("id", f"{n}L AS t")
    got = [r.x for r in df.select(ntile_of("id", "t", 10).alias("x")).collect()]
    size, extra = divmod(n, 10)
    want = [t + 1 for t in range(10) for _ in range(size + (1 if t < extra else 0))]
    assert sorted(got) == want


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 11, 50, 101, 199, 1003])
def test_equal_groups_match_qcut_of_ranks(spark, n):
    df = spark.range(n).selectExpr("id", f"{n}L AS t").orderBy("id")
    got = [r.x for r in df.select("id", equal_groups("id", "t", 5).alias("x")).collect()]
    want = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_equal_groups_differ_from_ntile(spark):
    df = spark.range(7).selectExpr("id", "7L AS t")
    pairs = df.select(equal_groups("id", "t", 5).alias("q"), ntile_of("id", "t", 5).alias("n"))
    assert any(r.q != r.n for r in pairs.collect())


def test_top_k_ranks_share_ties(spark):
    df = frame(spark, [9, 8, 8, 7, 6])
    got = top_k(df, 4, "value", ["key"], "rank").orderBy("rank", "key").collect()
    assert [(r.value, r["rank"]) for r in got] == [(9, 1), (8, 2), (8, 2), (7, 4)]
