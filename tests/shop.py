"""A tiny raw export, built by hand, for edge cases."""

from __future__ import annotations

from basketlens.plans.cleaning import build_star
from basketlens.sources.raw_files import RAW_SCHEMAS

PRODUCTS = [
    (1, "Lamp", "Acme", "Red", "$4.00 ", "$10.00 ", "11", "Lamps", "1", "Home"),
    (2, "Desk", "Acme", "Blue", "$600.10 ", "$1,060.22 ", "12", "Desks", "1", "Home"),
    (3, "Phone", "Zeta", "Black", "$50.00 ", "$100.00 ", "21", "Phones", "2", "Tech"),
    (4, "Relic", "Zeta", "Grey", "$1.00 ", "$2.00 ", "22", "Relics", "2", "Tech"),
]
CUSTOMERS = [
    (k, "Female" if k % 2 else "Male", n, "Town", None if k == 3 else "ST", "State", "01234",
     c, "Europe", "2/3/1980")
    for k, n, c in [
        (1, "Ann", "France"), (2, "Bob", "France"), (3, "Cid", "Italy"), (4, "Ann", "Italy"),
        (5, "Eve", "Spain"),
    ]
]
STORES = [
    (0, "Online", "Online", None, "1/1/2010"),
    (1, "France", "Paris", 500.0, "1/12/2008"),
    (2, "Italy", "Rome", 250.0, "3/4/2009"),
]
RATES = [("1/1/2019", "EUR", 0.9), ("1/1/2019", "USD", 1.0), ("2/1/2019", "EUR", 0.8)]


def sale(order, line, date, customer, product=1, quantity=1, store=1, delivery=None, code="EUR"):
    return (order, line, date, delivery, customer, store, product, quantity, code)


def raw_shop(spark, sales, products=None, customers=None, stores=None, rates=None):
    rows = {
        "sales": sales,
        "products": PRODUCTS if products is None else products,
        "customers": CUSTOMERS if customers is None else customers,
        "stores": STORES if stores is None else stores,
        "exchange_rates": RATES if rates is None else rates,
    }
    return {n: spark.createDataFrame(r, RAW_SCHEMAS[n]) for n, r in rows.items()}


def shop_star(spark, sales, **tables):
    return build_star(raw_shop(spark, sales, **tables))


def rows(df, *keys):
    """All rows as dicts, ordered by ``keys``."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: [str(r[k]) for k in keys])
