import pytest

from basketlens.plans import quality as Q
from basketlens.plans.cleaning import clean_products, clean_sales
from basketlens.plans.profiling import (
    profile_currency_gap,
    profile_duplicate_names,
    profile_fx_coverage,
    profile_order_dates,
    profile_referential,
    profile_tables,
)
from basketlens.sources.star import Star
from shop import CUSTOMERS, PRODUCTS, raw_shop, sale, shop_star

GOOD = [
    sale(1, 1, "1/1/2019", 1, delivery="1/2/2019"),
    sale(1, 2, "1/1/2019", 1, product=2),
    sale(2, 1, "1/3/2019", 2, product=3),
]


def found(df):
    return {r.check_name: (r.observed, r.passed) for r in df.collect()}


def test_clean_data_passes_everything(spark):
    star = shop_star(spark, GOOD)
    raw = raw_shop(spark, GOOD)
    sales = clean_sales(raw["sales"], clean_products(raw["products"]))
    checks = Q.clean_suite(star).unionByName(Q.star_suite(star, raw, sales))
    results = found(checks)
    assert checks.count() == 13 + 21
    assert all(passed for _, passed in results.values()), results
    Q.require_passed(checks)


def test_row_checks_count_violations(spark):
    bad = [
        *GOOD,
        sale(3, 1, "x", 1),
        sale(4, 1, "1/9/2019", 1, delivery="1/8/2019"),
        sale(5, 1, "1/9/2019", 1, quantity=0),
        sale(6, 1, "1/9/2019", 1, quantity=None),
        sale(7, 1, "1/9/2019", 1, product=99),
    ]
    got = found(Q.row_checks(shop_star(spark, bad)))
    assert got["order_date_valid"] == (1.0, False)
    assert got["delivery_before_order"] == (1.0, False)
    assert got["quantity_valid"] == (2.0, False)
    # Nulls on either side fail the recomputation.
    assert got["revenue_recompute"] == (2.0, False)
    # A CHECK lets the null quantity pass.
    assert got["check_quantity_constraint"] == (1.0, False)
    assert got["negative_profit"] == (0.0, True)


def test_duplicate_and_null_keys(spark):
    customers = [*CUSTOMERS, CUSTOMERS[0], (None, *CUSTOMERS[1][1:])]
    star = shop_star(spark, [*GOOD, GOOD[0], GOOD[0]], customers=customers)
    assert found(Q.dup_transaction_key(star))["dup_transaction_key"] == (2.0, False)
    assert found(Q.customer_key_unique(star))["customer_key_unique"] == (1.0, False)
    assert found(Q.duplicate_groups(star))["duplicate_groups"] == (1.0, False)
    keys = found(Q.primary_keys(star))
    # One duplicate and one null key.
    assert keys["dim_customer.customer_key"] == (2.0, False)
    assert keys["dim_product.product_key"] == (0.0, True)


def test_a_null_in_the_line_key_is_no_duplicate_but_no_key(spark):
    star = shop_star(spark, [*GOOD, (None, *GOOD[0][1:])])
    assert found(Q.dup_transaction_key(star))["dup_transaction_key"] == (0.0, True)
    assert found(Q.fact_composite_key(star))["fact_composite_key"] == (1.0, False)


def test_each_relationship_reports_its_orphans(spark):
    star = shop_star(spark, GOOD)
    tables = {n: star.table(n) for n in (
        "dim_category", "dim_subcategory", "dim_product", "dim_customer", "dim_store",
        "dim_date", "exchange_rate", "fact_sales",
    )}

    def with_table(name, condition):
        return Star({**tables, name: tables[name].where(condition)})

    cases = {
        "fact_sales.customer_key": ("dim_customer", "customer_key <> 1", 2.0),
        "fact_sales.product_key": ("dim_product", "product_key <> 3", 1.0),
        "fact_sales.store_key": ("dim_store", "store_key <> 1", 3.0),
        "fact_sales.order_date": ("dim_date", "date_key <> DATE'2019-01-03'", 1.0),
        "dim_product.subcategory_key": ("dim_subcategory", "subcategory_key <> '11'", 1.0),
        "dim_subcategory.category_key": ("dim_category", "category_key <> '2'", 2.0),
    }
    for name, (table, keep, orphans) in cases.items():
        got = found(Q.foreign_keys(with_table(table, keep)))
        assert got[name] == (orphans, False)
        assert got["all_foreign_keys"] == (orphans, False)
        others = [v for k, v in got.items() if k not in (name, "all_foreign_keys")]
        assert all(v == (0.0, True) for v in others)


def test_category_label_conflict(spark):
    products = [*PRODUCTS, (9, "Odd", "Acme", "Red", "$1 ", "$2 ", "31", "Odd", "1", "House")]
    star = shop_star(spark, GOOD, products=products)
    assert found(Q.category_key_1to1(star))["category_key_1to1"] == (1.0, False)


def test_bad_prices(spark):
    products = [*PRODUCTS[:3], (4, "R", "Z", "G", "free", "$-2.00 ", "22", "Relics", "2", "Tech")]
    star = shop_star(spark, GOOD, products=products)
    assert found(Q.price_valid(star))["price_valid"] == (1.0, False)
    assert found(Q.cost_valid(star))["cost_valid"] == (1.0, False)


def test_row_counts_and_reconciliation(spark):
    star = shop_star(spark, GOOD)
    raw = raw_shop(spark, [*GOOD, sale(9, 1, "1/1/2019", 1)])
    assert found(Q.row_counts(star, raw))["fact_sales"] == (-1.0, False)
    sales = clean_sales(raw["sales"], clean_products(raw["products"]))
    assert found(Q.revenue_reconciles(star, sales))["revenue_reconciles"] == (10.0, False)


def test_slices_lose_rows_without_a_customer(spark):
    star = shop_star(spark, [*GOOD, sale(3, 1, "1/4/2019", 77, product=3)])
    got = found(Q.slice_reconciliation(star))
    assert got["year"] == (0.0, True)
    assert got["customer_country"] == (100.0, False)


def test_require_passed_names_the_failures(spark):
    star = shop_star(spark, [*GOOD, GOOD[0]])
    with pytest.raises(Q.QualityError, match="dup_transaction_key"):
        Q.require_passed(Q.dup_transaction_key(star))


def test_profiles_of_broken_input(spark):
    sales = [
        *GOOD,
        GOOD[0],
        sale(3, 1, "bad", 88, product=99, delivery="bad", code="XXX"),
    ]
    raw = raw_shop(spark, sales)
    tables = {r.table_name: r for r in profile_tables(raw).collect()}
    assert (tables["sales"].n_rows, tables["sales"].duplicate_rows) == (5, 1)
    dates = profile_order_dates(raw).first()
    assert dates.order_date_unreadable == 1
    assert (dates.delivery_date_missing, dates.delivery_date_invalid) == (2, 1)
    references = {r.key_name: r for r in profile_referential(raw).collect()}
    assert references["customer_key"].orphan_rows == 1
    assert references["store_key"].orphan_keys == 0
    gap = profile_currency_gap(raw).first()
    assert (gap.currency, gap.n_lines) == ("XXX", 1)
    assert profile_fx_coverage(raw).first().covered is True
    names = profile_duplicate_names(raw).first()
    assert (names.shared_names, names.customers_sharing) == (1, 2)


def test_suites_find_what_the_single_checks_find(spark):
    customers = [*CUSTOMERS, CUSTOMERS[0], (None, *CUSTOMERS[1][1:])]
    bad = [
        *GOOD, GOOD[0], GOOD[0],
        (None, *GOOD[0][1:]),
        (8, None, *GOOD[0][2:]),
        sale(3, 1, "x", 1),
        sale(4, 1, "1/9/2019", 77, delivery="1/8/2019"),
        sale(5, 1, "1/9/2019", 1, quantity=0),
        sale(7, 1, "1/9/2019", 1, product=99, store=50),
        (9, 1, "1/9/2019", None, None, None, 1, 1, "EUR"),
    ]
    star, raw = shop_star(spark, bad, customers=customers), raw_shop(spark, bad, customers=customers)
    sales = clean_sales(raw["sales"], clean_products(raw["products"]))
    clean = found(Q.clean_suite(star))
    for check in (Q.dup_transaction_key, Q.customer_key_unique, Q.orphan_customer, Q.order_has_lines,
                  Q.category_key_1to1, Q.price_valid, Q.total_revenue_positive):
        for name, result in found(check(star)).items():
            assert clean[name] == result, name
    rows = found(Q.row_checks(star))
    assert all(clean[n] == rows[n] for n in Q.CLEAN_ROWS)
    suite = found(Q.star_suite(star, raw))
    assert suite == found(Q.star_suite(star, raw, sales))
    single = {}
    for check in (Q.primary_keys, Q.fact_composite_key, Q.duplicate_groups, Q.foreign_keys):
        single.update(found(check(star)))
    single.update(found(Q.row_counts(star, raw)))
    single.update(found(Q.revenue_reconciles(star, sales)))
    assert suite == single
    # Nothing points to a customer without a key, though there is one.
    assert suite["fact_sales.customer_key"] == (2.0, False)


def test_suites_read_the_fact_once(spark, tmp_path):
    star = shop_star(spark, GOOD)
    star.table("fact_sales").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    calls = []

    class Counted(Star):
        def table(self, name):
            if name == "fact_sales":
                calls.append(name)
            return super().table(name)

    tables = {n: star.table(n) for n in ("dim_category", "dim_subcategory", "dim_product",
                                         "dim_customer", "dim_store", "dim_date", "exchange_rate")}
    counted = Counted({**tables, "fact_sales": fact})
    numbers = Q.suite_numbers(counted)
    reads = len(calls)
    checks = Q.clean_suite(counted, numbers).unionByName(Q.star_suite(counted, raw_shop(spark, GOOD), numbers=numbers))
    assert checks.count() == 34
    plan = checks._jdf.queryExecution().optimizedPlan().toString()
    assert reads >= 1 and "order_number" not in plan
