import pandas as pd
import pytest

from basketlens.plans import rfm
from shop import sale, shop_star


def pandas_scores(base):
    base = base.sort_values("customer_key").reset_index(drop=True)
    base["r"] = pd.qcut(base.recency_days, 5, labels=[5, 4, 3, 2, 1]).astype(int)
    base["f"] = pd.qcut(base.frequency.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    base["m"] = pd.qcut(base.monetary_cents, 5, labels=[1, 2, 3, 4, 5]).astype(int)
    base["fm"] = ((base.f + base.m) / 2).round().astype(int).clip(1, 5)
    return base.set_index("customer_key")


def test_scores_match_quantile_cuts(star):
    got = rfm.rfm_segments(star).toPandas().set_index("customer_key").sort_index()
    want = pandas_scores(got.reset_index()[
        ["customer_key", "recency_days", "frequency", "monetary_cents"]
    ])
    for ours, theirs in [("r_score", "r"), ("f_score", "f"), ("m_score", "m"), ("fm_score", "fm")]:
        assert got[ours].tolist() == want[theirs].tolist(), ours
    labels = want.r.astype(str) + want.f.astype(str) + want.m.astype(str)
    assert got.rfm_score_label.tolist() == labels.tolist()
    rows = list(reversed(rfm.SEGMENT_GRID))
    segments = [rows[r - 1][fm - 1] for r, fm in zip(want.r, want.fm)]
    assert got.segment.tolist() == segments


def test_summary_reconciles(star):
    segments = rfm.rfm_segments(star)
    summary = rfm.segment_summary(segments).toPandas()
    assert summary.num_customers.sum() == star.customers().count()
    total = star.revenue_total().first().total_cents / 100
    assert summary.total_revenue_usd.sum() == pytest.approx(total)
    assert summary.pct_of_customers.sum() == pytest.approx(100, abs=0.1)
    watched = rfm.segment_filtered(segments).toPandas()
    assert set(watched.segment) <= set(rfm.AT_RISK_SEGMENTS)
    years = rfm.segment_last_order_year(segments).toPandas()
    assert years.num_customers.sum() == summary.num_customers.sum()


def test_recency_counts_from_the_day_after_the_last_order(spark):
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 1), sale(2, 1, "1/31/2019", 2)])
    got = {r.customer_key: r for r in rfm.rfm_base(star).collect()}
    assert (got[1].recency_days, got[2].recency_days) == (31, 1)
    # Registered but never ordered: no row.
    assert set(got) == {1, 2}


def test_coinciding_edges_are_an_error(spark):
    base = spark.createDataFrame([(k, 3) for k in range(20)], "customer_key bigint, x bigint")
    with pytest.raises(Exception, match="edges of x coincide"):
        base.select(rfm.quantile_bounds(base, "x")).collect()


def test_grid_has_ten_segments():
    assert len({name for row in rfm.SEGMENT_GRID for name in row}) == 10
