from basketlens.plans import customers, sales
from basketlens.sources.star import TABLES, Star
from shop import rows, sale, shop_star


def test_never_ordered_and_never_sold(spark):
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 1), sale(2, 1, "1/2/2019", 2, product=3)])
    got = customers.customers_with_zero_orders(star).first()
    assert got.total_customers_in_master_data == 5
    assert got.customers_with_at_least_one_order == 2
    assert (got.customers_never_ordered, got.pct_never_ordered) == (3, 60.0)
    assert sales.products_never_sold(star).first().products_never_sold == 2


def test_two_lines_of_one_order_are_one_purchase(spark):
    star = shop_star(
        spark,
        [
            sale(1, 1, "1/1/2019", 1), sale(1, 2, "1/1/2019", 1, product=3),
            sale(2, 1, "1/1/2019", 2), sale(3, 1, "1/1/2019", 2),
        ],
    )
    types = {r.customer_type: r for r in customers.repeat_vs_onetime_customers(star).collect()}
    assert types["One-time (1 order)"].num_customers == 1
    assert types["Repeat (2+ orders)"].pct_of_customers == 50.0
    spans = {r.lifespan_bucket: r.num_customers
             for r in customers.customer_lifespan_summary(star).collect()}
    assert spans == {"Single order (no lifespan)": 1, "Multiple orders, same day": 1}


def test_growth_edges(spark):
    """A zero previous month gives no percentage; the first month gives no change."""
    free = [(9, "Gift", "Acme", "Red", "$0.00 ", "$0.00 ", "11", "Lamps", "1", "Home"),
            (1, "Lamp", "Acme", "Red", "$4.00 ", "$10.00 ", "11", "Lamps", "1", "Home")]
    star = shop_star(
        spark,
        [
            sale(1, 1, "1/1/2019", 1, product=9), sale(2, 1, "2/1/2019", 1),
            sale(3, 1, "5/1/2019", 1, quantity=3),
        ],
        products=free,
    )
    got = rows(sales.monthly_revenue_and_growth(star), "year_month")
    assert [r["revenue_change_usd"] for r in got] == [None, 10.0, 20.0]
    assert [r["mom_growth_pct"] for r in got] == [None, None, 200.0]
    year = sales.yearly_revenue_and_growth(star).collect()
    assert [(r.year_completeness, r.yoy_growth_pct) for r in year] == [("PARTIAL YEAR", None)]


def test_last_year_is_left_out_of_category_growth(spark):
    star = shop_star(
        spark, [sale(1, 1, "1/1/2018", 1), sale(2, 1, "1/1/2019", 1), sale(3, 1, "12/31/2020", 1)]
    )
    got = rows(sales.category_growth_yoy(star), "year")
    assert [(r["year"], r["yoy_growth_pct"]) for r in got] == [(2018, None), (2019, 0.0)]


def test_deciles_with_few_customers(spark):
    star = shop_star(spark, [sale(k, 1, "1/1/2019", k, quantity=k) for k in range(1, 6)])
    got = rows(customers.revenue_concentration_deciles(star), "decile")
    assert [r["num_customers"] for r in got] == [1] * 5
    assert got[0]["decile_revenue_usd"] == 50.0
    assert sorted(r["cumulative_pct_of_revenue"] for r in got)[-1] == 100.0


def test_share_divides_by_the_whole_fact(spark):
    """Rows without a customer row count in the denominator."""
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 1), sale(2, 1, "1/1/2019", 77)])
    got = sales.revenue_by_customer_country(star).collect()
    assert [(r.country, r.pct_of_total_revenue) for r in got] == [("France", 50.0)]


def test_order_spanning_two_stores_counts_once_per_slice(spark):
    star = shop_star(
        spark,
        [sale(1, 1, "1/1/2019", 1, store=0), sale(1, 2, "1/1/2019", 1, store=1),
         sale(1, 3, "1/1/2019", 1, store=2)],
    )
    channels = {r.channel: r.total_orders for r in sales.revenue_by_channel(star).collect()}
    assert channels == {"Online": 1, "In-Store": 1}
    assert sales.kpi_summary(star).first().total_orders == 1


def test_order_number_shared_by_two_customers_is_one_order(spark):
    """Distinct counts never assume one customer per order."""
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 1), sale(1, 2, "1/1/2019", 2)])
    got = sales.revenue_by_customer_country(star).first()
    assert (got.total_orders, got.total_customers) == (1, 2)
    assert sales.kpi_summary(star).first().total_orders == 1


def test_category_share_keeps_lines_without_a_product_in_the_total(spark):
    star = shop_star(spark, [sale(1, 1, "1/1/2019", 1), sale(2, 1, "1/1/2019", 1, product=3)])
    tables = {n: star.table(n) for n in TABLES}
    tables["dim_product"] = tables["dim_product"].where("product_key <> 3")
    tables["dim_store"] = tables["dim_store"].where("store_key <> 1")
    partial = Star(tables)
    got = sales.category_revenue(partial).collect()
    assert [(r.category_name, r.pct_of_total_revenue) for r in got] == [("Home", 9.09)]
    assert sales.revenue_by_channel(partial).collect() == []
