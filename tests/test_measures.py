import datetime as dt
import random

import pytest

from basketlens.plans.measures import BLOCKS, measures_by
from shop import CUSTOMERS, rows, sale, shop_star


def test_global_context(spark):
    star = shop_star(
        spark,
        [sale(1, 1, "1/1/2019", 1), sale(1, 2, "1/1/2019", 1, product=3), sale(2, 1, "1/2/2019", 1),
         sale(3, 1, "1/3/2019", 2, quantity=2)],
    )
    measures = [m for m in BLOCKS if m != "revenue_yoy_growth_pct"]
    got = measures_by(star, measures).first().asDict()
    assert got["total_revenue"] == 140.0
    assert (got["total_orders"], got["total_customers"], got["units_sold"]) == (3, 2, 5)
    assert got["average_order_value"] == 46.67
    assert got["median_order_value"] == 20.0
    assert got["revenue_per_customer"] == got["historical_clv"] == 70.0
    assert (got["repeat_customers"], got["repeat_purchase_rate_pct"]) == (1, 50.0)
    assert got["new_customers"] == 2


def test_orders_are_counted_once_per_group(spark):
    """Lines are reduced to orders, so nothing counts them as distinct again."""
    star = shop_star(
        spark, [sale(1, 1, "5/1/2018", 1), sale(1, 2, "5/1/2018", 1, product=3), sale(2, 1, "6/1/2018", 2), sale(3, 1, "5/1/2019", 1)]
    )
    found = measures_by(star, ["average_order_value", "total_orders", "median_order_value"], ["year"])
    assert [r["total_orders"] for r in rows(found, "year")] == [2, 1]
    assert "count(distinct" not in found._jdf.queryExecution().toString()


def test_repeat_scopes(spark):
    star = shop_star(spark, [sale(1, 1, "5/1/2018", 1), sale(2, 1, "5/1/2019", 1)])
    got = rows(
        measures_by(star, ["repeat_customers", "repeat_customers_in_context"], ["year"]), "year"
    )
    assert [r["repeat_customers"] for r in got] == [1, 1]
    assert [r["repeat_customers_in_context"] for r in got] == [0, 0]


def test_new_customers_look_at_all_history(spark):
    """A filter on 2019 must not make an old customer new."""
    star = shop_star(
        spark, [sale(1, 1, "5/1/2018", 1), sale(2, 1, "5/1/2019", 1), sale(3, 1, "6/1/2019", 2)]
    )
    got = measures_by(star, ["new_customers", "total_customers"], ["year"], {"year": 2019}).first()
    assert (got.new_customers, got.total_customers) == (1, 2)


def test_yoy_needs_the_same_period(spark):
    star = shop_star(
        spark,
        [
            sale(1, 1, "1/10/2018", 1), sale(2, 1, "3/10/2018", 1, quantity=2),
            sale(3, 1, "1/20/2019", 1, quantity=3), sale(4, 1, "2/1/2019", 1),
            sale(5, 1, "6/1/2019", 1),
        ],
    )
    by_month = {
        (r.year, r.month): r.revenue_yoy_growth_pct
        for r in measures_by(star, ["revenue_yoy_growth_pct"], ["year", "month"]).collect()
    }
    assert by_month[2019, 1] == 200.0
    # February 2018 had no sales: blank, although January 2018 had.
    assert by_month[2019, 2] is None
    # March 2018 had sales, March 2019 none.
    assert by_month[2019, 3] == -100.0
    assert by_month[2018, 1] is None


def test_yoy_compares_a_partial_year_with_the_same_dates(spark):
    star = shop_star(
        spark,
        [sale(1, 1, "1/10/2018", 1), sale(2, 1, "11/1/2018", 1, quantity=9),
         sale(3, 1, "3/1/2019", 1, quantity=2)],
    )
    got = {r.year: r.revenue_yoy_growth_pct
           for r in measures_by(star, ["revenue_yoy_growth_pct"], ["year"]).collect()}
    assert got[2019] == 100.0


def test_leap_day_counts_once(spark):
    star = shop_star(
        spark, [sale(1, 1, "2/28/2020", 1), sale(2, 1, "2/29/2020", 1), sale(3, 1, "2/28/2021", 1)]
    )
    got = {(r.year, r.month): r.revenue_yoy_growth_pct
           for r in measures_by(star, ["revenue_yoy_growth_pct"], ["year", "month"]).collect()}
    assert got[2021, 2] == -50.0


def test_null_groups_line_up(spark):
    customers = [*CUSTOMERS, (9, "Male", "Nil", None, None, None, None, None, None, None)]
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 9), sale(2, 1, "1/1/2019", 1)],
                     customers=customers)
    got = measures_by(star, ["total_revenue", "total_customers"], ["customer_country"]).collect()
    assert {(r.customer_country, r.total_revenue, r.total_customers) for r in got} == {
        (None, 10.0, 1), ("France", 10.0, 1)
    }


def test_filters_join_only_what_they_name(star):
    plan = measures_by(star, ["total_revenue"], ["year"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "supplier" not in text and "customer.parquet" not in text
    assert "s_suppkey" not in text and "c_custkey" not in text


def test_unknown_measure(star):
    with pytest.raises(ValueError):
        measures_by(star, ["profit_per_smile"])


def test_measures_by_segment(spark):
    star = shop_star(
        spark,
        [sale(1, 1, "1/1/2019", 1), sale(2, 1, "1/2/2019", 1), sale(3, 1, "1/3/2019", 2, quantity=2),
         sale(4, 1, "1/4/2019", 3, product=3)],
    )
    with pytest.raises(ValueError, match="segment"):
        measures_by(star, ["total_revenue"], ["segment"])
    segments = spark.createDataFrame([(1, "A"), (2, "B"), (3, "B")], "customer_key bigint, segment string")
    known = star.with_segments(segments)
    got = rows(measures_by(known, ["total_revenue", "total_orders", "repeat_customers"], ["segment"]), "segment")
    assert [tuple(r.values()) for r in got] == [("A", 20.0, 2, 1), ("B", 120.0, 2, 0)]
    only = measures_by(known, ["total_customers", "new_customers"], filters={"segment": "B"}).first()
    assert (only.total_customers, only.new_customers) == (2, 2)


def plain_measures(sales, dims, wanted):
    """All measures of one pass, sale by sale; products 1 and 3 cost 10 and 100."""
    price = {1: 10, 2: 1060.22, 3: 100, 4: 2}
    lines = [
        {"order": o, "day": d, "customer": c, "cents": None if p not in price else round(q * price[p] * 100),
         "q": q, "year": d.year, "month": d.month, "country": COUNTRY.get(c), "known": c in COUNTRY}
        for o, d, c, p, q in sales
    ]
    last = max(r["day"] for r in lines)
    ever, first = {}, {}
    for r in lines:
        ever.setdefault(r["customer"], set()).add(r["order"])
        first[r["customer"]] = min(first.get(r["customer"], r["day"]), r["day"])
    groups = {}
    passing = [r for r in lines if r["known"] and wanted(r)]
    for r in passing:
        groups.setdefault(tuple(r[d] for d in dims), []).append(r)
    out = {}
    for key, held in groups.items():
        customers = {r["customer"] for r in held}
        out[key] = (
            sum(r["cents"] or 0 for r in held) / 100, len({r["order"] for r in held}), len(customers), sum(r["q"] for r in held),
            sum(len(ever[c]) >= 2 for c in customers),
            sum(len({r["order"] for r in held if r["customer"] == c}) >= 2 for c in customers),
            sum(min(r["day"] for r in held if r["customer"] == c) == first[c] for c in customers),
        )
    prior, current = {}, {}
    for r in lines:
        if not r["known"]:
            continue
        try:
            later = r["day"].replace(year=r["day"].year + 1)
        except ValueError:
            later = r["day"].replace(year=r["day"].year + 1, day=28)
        for total, day in ((current, r["day"]), (prior, later)):
            shown = {**r, "day": day, "year": day.year, "month": day.month}
            if day <= last and wanted(shown):
                key = tuple(shown[d] for d in dims)
                total[key] = total.get(key, 0) + (r["cents"] or 0)
    for key in {*out, *prior, *current}:
        growth = None
        if prior.get(key):
            growth = (current.get(key, 0) - prior[key]) / prior[key] * 100
        out[key] = (*out.get(key, (None,) * 7), growth)
    return out


COUNTRY = {k: c[7] for c in CUSTOMERS for k in [c[0]]}


@pytest.mark.parametrize("dims,filters", [
    ((), {}), (("year",), {}), (("year", "month", "country"), {}), (("country",), {"year": [2019]}),
    (("year",), {"customer_country": "France"}),
])
def test_one_pass_equals_plain_measures(spark, dims, filters):
    pick = random.Random(11)
    dates = [dt.date(2018, 1, 1) + dt.timedelta(days=pick.randint(0, 1_000)) for _ in range(60)] + [dt.date(2020, 2, 29)]
    orders = [(i, d, pick.choice([1, 1, 1, 2, 3, 4, 77])) for i, d in enumerate(dates)]
    sales = [(o, d, c, pick.choice([1, 3]), pick.randint(1, 5)) for o, d, c in orders for _ in range(pick.randint(1, 3))]
    lines = [
        sale(o, n, f"{d.month}/{d.day}/{d.year}", c, product=p, quantity=q) for n, (o, d, c, p, q) in enumerate(sales)
    ]
    measures = [
        "total_revenue", "total_orders", "total_customers", "units_sold", "repeat_customers",
        "repeat_customers_in_context", "new_customers", "revenue_yoy_growth_pct",
    ]
    names = [{"country": "customer_country"}.get(d, d) for d in dims]
    # The customer's country is always read, so that lines without a customer stay out here as there.
    all_ = [*names, "customer_country"] if "customer_country" not in [*names, *filters] else names
    if all_ != names:
        dims = (*dims, "country")
    found = {
        tuple(r[n] for n in all_): tuple(r[m] for m in measures)
        for r in measures_by(shop_star(spark, lines), measures, all_, filters).collect()
    }
    tests = {"year": lambda r: r["year"] == 2019, "customer_country": lambda r: r["country"] == "France"}
    want = plain_measures(sales, dims, lambda r: all(tests[f](r) for f in filters))
    assert found.keys() == want.keys()
    for key, values in want.items():
        assert found[key][:7] == values[:7], key
        assert found[key][7] == (None if values[7] is None else pytest.approx(values[7], abs=0.006)), key
