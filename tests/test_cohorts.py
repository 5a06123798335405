import datetime as dt

import pytest

from basketlens.plans import cohorts as C
from shop import rows, sale, shop_star

# Size and Month-1 returners of 62 consecutive monthly cohorts
# from January 2016, from a published retention table.
SIZES = [
    289, 318, 103, 39, 213, 220, 178, 199, 234, 220, 210, 338, 247, 283, 98, 21, 184, 194, 168,
    194, 196, 203, 215, 373, 257, 318, 112, 23, 275, 264, 237, 276, 277, 288, 295, 482, 373, 382,
    135, 31, 259, 248, 229, 231, 234, 205, 220, 285, 215, 235, 67, 19, 101, 68, 47, 29, 31, 38,
    33, 64, 34, 33,
]
RETURNED = [
    9, 5, 1, 1, 6, 5, 5, 3, 3, 5, 8, 4, 3, 1, 0, 0, 3, 4, 2, 4, 2, 2, 6, 6, 4, 5, 1, 2, 8, 12, 5,
    16, 14, 11, 19, 23, 26, 12, 0, 2, 8, 18, 10, 12, 17, 5, 19, 18, 15, 3, 0, 0, 3, 2, 1, 0, 1, 0,
    0, 2, 0,
]


@pytest.fixture(scope="module")
def published(spark):
    first = 2016 * 12
    cells = [(first + i, 0, n) for i, n in enumerate(SIZES)]
    # Months in which nobody returned have no row, as in real counts.
    cells += [(first + i, 1, n) for i, n in enumerate(RETURNED) if n]
    schema = "cohort int, period_number int, active bigint"
    return C.cohort_grid(spark.createDataFrame(cells, schema))


def test_published_month1_statistics(published):
    stats = C.cohort_month1_stats(published).first()
    assert stats.cohorts == 61
    assert round(stats.mean_pct, 2) == 2.84
    assert round(stats.std_pct, 2) == 2.34
    assert (stats.best_cohort, round(stats.best_pct, 2)) == (dt.date(2018, 4, 1), 8.70)
    assert (stats.worst_cohort, stats.worst_pct) == (dt.date(2017, 3, 1), 0.0)
    assert round(C.month1_retention(published).first().month1_retention_pct, 2) == 2.84


def test_published_trend_and_sizes(published):
    trend = C.cohort_month1_trend(published).first()
    assert (trend.cohorts, trend.trend) == (61, "weak/no trend")
    assert round(trend.trend_correlation, 3) == 0.183
    sizes = C.cohort_size_range(published).first()
    assert (sizes.cohorts, sizes.min_size, sizes.max_size) == (62, 19, 482)
    assert (sizes.first_cohort, sizes.last_cohort) == (dt.date(2016, 1, 1), dt.date(2021, 2, 1))
    large = C.cohort_month1_large(published).first()
    assert (large.best_cohort, round(large.best_pct, 2)) == (dt.date(2019, 11, 1), 8.64)
    assert (large.worst_cohort, large.worst_pct) == (dt.date(2019, 3, 1), 0.0)


def test_published_new_customers_per_year(published):
    sizes = C.cohort_matrix(published).selectExpr("year(cohort_month) AS y", "period_0 AS n")
    got = {r.y: r.s for r in sizes.groupBy("y").agg({"n": "sum"}).toDF("y", "s").collect()}
    assert got == {2016: 2561, 2017: 2376, 2018: 3104, 2019: 2832, 2020: 947, 2021: 67}


def test_grid_rules(spark):
    # Cohort January: returns in March only. No new customers in February.
    star = shop_star(
        spark,
        [
            sale(1, 1, "1/5/2019", 1), sale(2, 1, "1/6/2019", 2), sale(3, 1, "3/1/2019", 1),
            sale(4, 1, "3/9/2019", 3), sale(5, 1, "3/20/2019", 3), sale(6, 1, "4/2/2019", 3),
        ],
    )
    grid = C.cohort_grid(C.cohort_active(star))
    got = [
        (r["cohort_month"].month, r["period_number"], r["active_customers"])
        for r in rows(grid, "cohort_month", "period_number")
    ]
    # January could reach period 3 (April), but no period beyond 2 was ever
    # observed. Reached without a return is 0; period 2 of March is unreached.
    assert got == [(1, 0, 2), (1, 1, 0), (1, 2, 1), (3, 0, 1), (3, 1, 1)]
    wide = C.cohort_matrix(grid).orderBy("cohort_month").collect()
    assert wide[0].asDict() == {
        "cohort_month": dt.date(2019, 1, 1), "period_0": 2, "period_1": 0, "period_2": 1,
    }
    assert wide[1].period_2 is None
    averages = {r.period_number: r for r in C.cohort_avg_retention(grid).collect()}
    assert averages[1].avg_retention_pct == 50.0 and averages[1].cohorts_averaged == 2
    assert averages[2].avg_retention_pct == 50.0 and averages[2].cohorts_averaged == 1
    assert 0 not in {r.period_number for r in C.cohort_curve(grid).collect()}


def test_assignment_of_orders(spark):
    star = shop_star(
        spark, [sale(1, 1, "12/5/2018", 1), sale(1, 2, "12/5/2018", 1), sale(2, 1, "2/1/2019", 1)]
    )
    got = rows(C.cohort_assign(star), "order_number")
    assert [(r["order_number"], r["period_number"]) for r in got] == [(1, 0), (2, 2)]


def test_trend_needs_more_than_two_cohorts(spark):
    schema = "cohort int, period_number int, active bigint"
    few = spark.createDataFrame([(10, 0, 5), (10, 1, 1), (11, 0, 5), (11, 1, 2), (12, 0, 1)], schema)
    assert C.cohort_month1_trend(C.cohort_grid(few)).first().trend_correlation is None
    flat = spark.createDataFrame(
        [(c, p, 4) for c in range(10, 14) for p in (0, 1)] + [(14, 0, 4)], schema
    )
    # A constant series has no correlation.
    assert C.cohort_month1_trend(C.cohort_grid(flat)).first().trend_correlation is None
