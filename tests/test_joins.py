from collections import Counter

import pytest

from basketlens.operators.joins import BROADCAST_BYTES, estimated_bytes, is_large, lookup_join


@pytest.fixture(scope="module")
def tables(spark):
    # Key 1 holds a third of the rows; some keys are null or unknown.
    keys = [1] * 400 + [k % 50 for k in range(700)] + [None] * 60 + [999] * 40
    facts = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id bigint, key bigint")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(50)], "key bigint, name string")
    return facts.repartition(4), dim


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 7, 100, 10**9])
def test_salted_join_equals_plain_join(tables, how, hot_rows):
    facts, dim = tables
    plain = facts.join(dim, "key", how).select("id", "key", "name").collect()
    salted = lookup_join(facts, dim, "key", how, broadcast_bytes=0, hot_rows=hot_rows)
    assert Counter(plain) == Counter(salted.select("id", "key", "name").collect())


def test_small_dimension_is_broadcast(tables):
    facts, dim = tables
    joined = lookup_join(facts, dim, "key")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    large = lookup_join(facts, dim, "key", broadcast_bytes=0)
    assert "_part" in large._jdf.queryExecution().optimizedPlan().toString()


def test_other_join_types_are_refused(tables):
    with pytest.raises(ValueError):
        lookup_join(*tables, "key", "full")


def test_estimate_ignores_products_of_joined_tables(spark, star):
    customers = star.table("dim_customer")
    assert estimated_bytes(customers) < BROADCAST_BYTES


def test_plans_do_not_depend_on_the_join_strategy(spark, folder, monkeypatch):
    """Forced to shuffle and salt, the reports stay the same."""
    from basketlens.operators import joins
    from basketlens.plans import cohorts, sales
    from basketlens.sources.mapped import MappedStar

    def report():
        star = MappedStar(spark, folder)
        return [
            Counter(plan(star).collect())
            for plan in (
                sales.category_revenue, sales.revenue_by_channel,
                sales.revenue_by_customer_country, cohorts.cohort_assign,
            )
        ]

    before = report()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    assert report() == before


def test_hot_keys_are_found_in_the_key_column(spark, folder, monkeypatch):
    """Three large lookups scan the lines once, plus one key column for each
    of the two line-level keys."""
    from basketlens.operators import joins
    from basketlens.sources.mapped import MappedStar

    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    star = MappedStar(spark, folder)
    wide = star.lines("category_name", "channel", "customer_country", "revenue_cents")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line and "l_orderkey" in line]
    # Each key count appears on both sides of its join; Spark runs it once.
    assert len(scans) == 1 + 2 * 2


def test_hot_key_is_cut_by_identity_where_other_columns_hardly_vary(spark):
    facts = spark.range(4000).selectExpr("1L AS key", "id", "id % 2 AS quantity")
    dim = spark.createDataFrame([(1, "a")], "key bigint, name string")
    joined = lookup_join(facts, dim, "key", broadcast_bytes=0, hot_rows=100, identity=["id"])
    assert joined.count() == 4000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(id" in plan and "quantity" not in plan.split("xxhash64(")[1].split(")")[0]


def test_a_compressed_dimension_is_not_taken_for_small(spark, tmp_path):
    """Two million regular rows are a small file and a large table."""
    path = str(tmp_path / "dim")
    spark.range(2_000_000).selectExpr("id AS key", "concat('name ', id % 10) AS name").write.parquet(path)
    dim = spark.read.parquet(path)
    assert is_large(dim)
    assert not is_large(spark.range(100).selectExpr("id AS key", "'a' AS name"))
