import random

from basketlens.operators.distinct import distinct_counts

KEYS = {"a": ["a"], "ab": ["a", "b"], "c": ["c"], "ba": ["b", "a"], "bac": ["b", "a", "c"]}


def brute(rows):
    return {
        "a": len({r[0] for r in rows if r[0] is not None}),
        "ab": len({r[:2] for r in rows}),
        "c": len({r[2] for r in rows if r[2] is not None}),
        "ba": len({(r[1], r[0]) for r in rows}),
        "bac": len({r[:3] for r in rows}),
    }


def test_counts_equal_brute_force(spark):
    pick = random.Random(1)
    edges = [None, -1, -64, -65, 0, 1, 63, 64, 2**62, -(2**63), 2**63 - 1]
    rows = [
        (pick.choice([*edges, pick.randint(-(10**6), 10**6)]), pick.choice([None, -3, 1, 2, 70, 100]),
         pick.choice([None, "", "a", "b"]), pick.choice(["x", "y", None]))
        for _ in range(2000)
    ]
    df = spark.createDataFrame(rows, "a bigint, b int, c string, g string")
    assert {r.label: r.distinct_values for r in distinct_counts(df, KEYS).collect()} == brute(rows)
    grouped = distinct_counts(df, KEYS, ["g"]).collect()
    for group in ("x", "y", None):
        found = {r.label: r.distinct_values for r in grouped if r.g == group}
        assert found == brute([r for r in rows if r[3] == group])


def test_words_merge_before_the_shuffle_and_nothing_expands(spark):
    df = spark.range(100_000).selectExpr("id AS a", "CAST(id % 7 AS INT) AS b", "'t' AS c")
    counted = distinct_counts(df, KEYS)
    assert {r.label: r.distinct_values for r in counted.collect()}["a"] == 100_000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert "partial_bit_or" in plan


def test_no_rows_no_labels(spark):
    assert distinct_counts(spark.createDataFrame([], "a bigint, b int, c string"), KEYS).collect() == []
