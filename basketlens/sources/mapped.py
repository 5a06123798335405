"""Star schema over order/lineitem tables.

The source keeps an order header (``orders``), its lines (``lineitem``) and
master tables. A sales line is a ``lineitem`` row with the date and customer
of its order and the list price of its product. Both lookups are left joins:
the number of sales lines never changes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.operators.joins import is_large, lookup_join
from basketlens.sources.star import (
    CENT_COLUMNS,
    FACT_COLUMNS,
    LINE_IDENTITY,
    PRODUCT_COLUMNS,
    Star,
    calendar,
    fixed_calendar,
    with_date_parts,
)

# Explicit schemas: opening a table needs no pass over file footers.
SOURCE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

# Trading currencies with their units per US dollar at the start
# of a year. The source has no rates, so they follow a formula of the date.
CURRENCIES = {"USD": "1.0", "CAD": "1.25", "AUD": "1.35", "EUR": "0.85", "GBP": "0.72"}
RATE_STEP = "0.0005"

_CODES = "array({})".format(", ".join(f"'{c}'" for c in CURRENCIES))
_BASE_RATE = "CASE currency {} END".format(
    " ".join(f"WHEN '{c}' THEN CAST({v} AS DECIMAL(12,6))" for c, v in CURRENCIES.items())
)
_DRIFT = f"CAST(dayofyear(rate_date) AS DECIMAL(5,0)) * CAST({RATE_STEP} AS DECIMAL(6,4))"
EXCHANGE = (
    f"CAST({_BASE_RATE} + CASE WHEN currency = 'USD' THEN 0 ELSE {_DRIFT} END AS DECIMAL(12,6))"
)

ORDER_COLUMNS = {
    "order_date": "CAST(o_orderdate AS DATE)",
    "customer_key": "o_custkey",
    "currency_code": f"element_at({_CODES}, CAST(pmod(o_custkey, {len(CURRENCIES)}) + 1 AS INT))",
}

LINE_COLUMNS = {
    "order_number": "l_orderkey",
    "line_item": "CAST(l_linenumber AS BIGINT)",
    "product_key": "l_partkey",
    "store_key": "l_suppkey",
    "quantity": "CAST(l_quantity AS INT)",
    "is_delivered": "coalesce(l_linestatus = 'F', false)",
    "delivery_date": "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END",
}

_PRICE = "CAST(p_retailprice AS DECIMAL(10,2))"
_COST_SHARE = "CAST((40 + pmod(p_size, 30)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(4,2))"
_COST = f"CAST(round({_PRICE} * {_COST_SHARE}, 2) AS DECIMAL(10,2))"

PART_COLUMNS = {
    "product_name": "p_name",
    "brand": "p_brand",
    "color": "element_at(split(p_name, ' '), 1)",
    "subcategory_key": "concat_ws('/', p_type, p_brand)",
    "subcategory_name": "p_brand",
    "category_key": "p_type",
    "category_name": "p_type",
    "unit_price_usd": _PRICE,
    "unit_cost_usd": _COST,
    "unit_price_cents": f"CAST({_PRICE} * 100 AS BIGINT)",
    "unit_cost_cents": f"CAST({_COST} * 100 AS BIGINT)",
}

CUSTOMER_SOURCE = {
    "customer_key": "c_custkey",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "name": "c_name",
    "city": "CAST(NULL AS STRING)",
    "state_code": "CAST(NULL AS STRING)",
    "state": "c_mktsegment",
    "zip_code": "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')",
    "country": "n_name",
    "continent": "r_name",
    "birthday": "date_add(DATE'1935-02-03', CAST(c_custkey * 37 % 24000 AS INT))",
}

_STORE_PLACE = "CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE n_name END"
STORE_SOURCE = {
    "store_key": "s_suppkey",
    "country": _STORE_PLACE,
    "state": _STORE_PLACE,
    "square_meters": "CASE WHEN s_suppkey % 5 <> 0 THEN CAST(200 + s_suppkey % 1800 AS DOUBLE) END",
    "open_date": "date_add(DATE'2005-03-04', CAST(s_suppkey * 53 % 5000 AS INT))",
    "is_online": f"coalesce({_STORE_PLACE} = 'Online', false)",
}

# Amount -> unit amount per line, in whole cents.
_UNIT_CENTS = {
    "revenue": "unit_price_cents",
    "cost": "unit_cost_cents",
    "profit": "(unit_price_cents - unit_cost_cents)",
}
AMOUNT_COLUMNS = {
    **{f"{n}_cents": f"quantity * {u}" for n, u in _UNIT_CENTS.items()},
    **{
        f"{n}_usd": f"CAST(CAST(quantity * {u} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"
        for n, u in _UNIT_CENTS.items()
    },
}
MONEY_COLUMNS = [*AMOUNT_COLUMNS, "unit_price_usd", "unit_cost_usd"]


def _exprs(names, table: dict[str, str]) -> list[str]:
    return [f"{table[n]} AS {n}" for n in names]


def _prices_for(money: list[str]) -> list[str]:
    """Price list columns that the given money columns are made of."""
    texts = [AMOUNT_COLUMNS.get(m, m) for m in money]
    units = ("unit_price_cents", "unit_cost_cents", "unit_price_usd", "unit_cost_usd")
    return [u for u in units if any(u in t for t in texts)]


class MappedStar(Star):
    """Star whose tables are views over the source tables in one folder."""

    one_customer_per_order = True  # the order header carries the customer
    derived_calendar = True

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__({})
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}
        self._span: tuple[date, date] | None = None

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            path = f"{self._folder}/{name}.parquet"
            self._sources[name] = self._spark.read.schema(SOURCE_SCHEMAS[name]).parquet(path)
        return self._sources[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = getattr(self, f"_{name}")()
        return self._tables[name]

    # -- dimensions ----------------------------------------------------------

    def _products(self, *cols: str) -> DataFrame:
        return self.source("part").selectExpr(
            "p_partkey AS product_key", *_exprs(cols, PART_COLUMNS)
        )

    def _dim_product(self) -> DataFrame:
        return self._products(
            "product_name", "brand", "color", "unit_cost_usd", "unit_price_usd", "subcategory_key"
        )

    def _dim_subcategory(self) -> DataFrame:
        cols = ["subcategory_key", "subcategory_name", "category_key"]
        return self.source("part").selectExpr(*_exprs(cols, PART_COLUMNS)).distinct()

    def _dim_category(self) -> DataFrame:
        cols = ["category_key", "category_name"]
        return self.source("part").selectExpr(*_exprs(cols, PART_COLUMNS)).distinct()

    def _customers(self, cols: list[str]) -> DataFrame:
        """Customer master with ``cols``; geography is read only if named."""
        df = self.source("customer")
        if {"country", "continent"} & set(cols):
            nations = self.source("nation").selectExpr(
                "n_nationkey AS c_nationkey", "n_name", "n_regionkey"
            )
            df = lookup_join(df, nations, "c_nationkey", "left")
        if "continent" in cols:
            regions = self.source("region").selectExpr("r_regionkey AS n_regionkey", "r_name")
            df = lookup_join(df, regions, "n_regionkey", "left")
        return df.selectExpr(*_exprs(cols, CUSTOMER_SOURCE))

    def _dim_customer(self) -> DataFrame:
        return self._customers(list(CUSTOMER_SOURCE))

    def _dim_store(self) -> DataFrame:
        nations = self.source("nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
        joined = lookup_join(self.source("supplier"), nations, "s_nationkey", "left")
        return joined.selectExpr(*_exprs(STORE_SOURCE, STORE_SOURCE))

    def remember_span(self, first: date, last: date) -> None:
        """Tell the first and last day of the orders that have lines, once known."""
        self._span = (first, last)
        for name in ("dim_date", "exchange_rate"):
            self._tables.pop(name, None)

    def _dim_date(self) -> DataFrame:
        if self._span:
            return fixed_calendar(self.spark, *(str(d) for d in self._span))
        # Only dates of orders that have lines count.
        span = self.orders("order_date").agg(
            F.min("order_date").alias("a"), F.max("order_date").alias("b")
        )
        return with_date_parts(span.select(*calendar(F.col("a"), F.col("b"))))

    def _exchange_rate(self) -> DataFrame:
        days = self.table("dim_date").selectExpr(
            "date_key AS rate_date", f"explode({_CODES}) AS currency"
        )
        return days.selectExpr("rate_date", "currency", f"{EXCHANGE} AS exchange")

    def _fact_sales(self) -> DataFrame:
        return self.fact(*FACT_COLUMNS)

    # -- views ---------------------------------------------------------------

    def product_flat(self, *cols: str) -> DataFrame:
        # Category and subcategory are attributes of the same row here.
        return self._products(*cols)

    def _headers(self, cols: list[str]) -> DataFrame:
        return self.source("orders").selectExpr(
            "o_orderkey AS order_number", *_exprs(cols, ORDER_COLUMNS)
        )

    def _fact_columns(
        self, cols: list[str], product_cols: list[str], how: str = "left"
    ) -> DataFrame:
        """Sales lines with ``cols``; order and product are read only if named."""
        money = [c for c in cols if c in MONEY_COLUMNS]
        header = [c for c in cols if c in ORDER_COLUMNS]
        need = [c for c in cols if c in LINE_COLUMNS]
        need += ["product_key"] if money or product_cols else []
        need += ["quantity"] if money else []
        need += ["order_number"] if header else []
        need += LINE_IDENTITY if (money or product_cols) and is_large(self._products()) else []
        df = self.source("lineitem").selectExpr(*_exprs(dict.fromkeys(need), LINE_COLUMNS))
        if money or product_cols:
            products = self._products(*_prices_for(money), *product_cols)
            if product_cols and how == "left":
                products = products.selectExpr("*", "true AS _product")
                product_cols = [*product_cols, "_product"]
            df = self.look_up(df, products, "product_key", how)
            # Amounts replace what only fed them before any further shuffle.
            keep = dict.fromkeys([*cols, *product_cols, *(["order_number"] if header else [])])
            df = df.selectExpr(
                *[
                    f"{AMOUNT_COLUMNS[c]} AS {c}" if c in AMOUNT_COLUMNS else c
                    for c in keep
                    if c not in header
                ]
            )
        if header:
            # Large to large. A hot order is split by the adaptive skew join.
            df = df.join(self._headers(header), "order_number", "left")
        return df

    def key_rows(self, key: str) -> DataFrame:
        # A customer's orders show well enough whether its lines are many.
        if key in ORDER_COLUMNS:
            return self._headers([key]).select(key)
        return self.source("lineitem").selectExpr(*_exprs([key], LINE_COLUMNS))

    def fact(self, *cols: str) -> DataFrame:
        return self._fact_columns(list(cols), []).select(*cols)

    def fact_with_product(
        self, fact_cols: list[str], product_cols: list[str], how: str = "inner"
    ) -> DataFrame:
        df = self._fact_columns(fact_cols, product_cols, how)
        return df.select(*fact_cols, *product_cols, *(["_product"] if how == "left" else []))

    def _order_totals(self, keys: list[str], totals: list[str]) -> DataFrame:
        # Reduce the lines to their order first, then attach the header: the
        # join sees one row per order on both sides, however hot an order is.
        reduced = super()._order_totals(["order_number"], totals)
        header = [k for k in keys if k in ORDER_COLUMNS]
        if not header:
            return reduced
        return reduced.join(self._headers(header), "order_number", "left")

    def product_totals(self, *totals: str) -> DataFrame:
        # Amounts are quantity times a price that is fixed per product, so
        # units are summed first and priced once per product.
        amounts = [t for t in totals if t in CENT_COLUMNS]
        if not amounts:
            return super().product_totals(*totals)
        base = [t for t in totals if t not in amounts]
        units = super().product_totals(*dict.fromkeys([*base, "quantity"]))
        priced = units.join(self._products(*_prices_for(amounts)), "product_key", "left")
        return priced.selectExpr(
            "product_key",
            *[f"{AMOUNT_COLUMNS[t]} AS {t}" if t in amounts else t for t in totals],
        )

    def line_value_counts(self, value: str, by: list[str] | None = None) -> DataFrame:
        # An amount depends on product and quantity only: lines are counted by
        # those, and each product's few quantities are priced once.
        by = list(by or [])
        if value not in AMOUNT_COLUMNS or not set(by) <= set(PRODUCT_COLUMNS):
            return super().line_value_counts(value, by)
        counted = (
            self.source("lineitem")
            .selectExpr(*_exprs(["product_key", "quantity"], LINE_COLUMNS))
            .groupBy("product_key", "quantity")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        priced = counted.join(self._products(*_prices_for([value]), *by), "product_key")
        return priced.selectExpr(*by, f"{AMOUNT_COLUMNS[value]} AS {value}", "n")

    def last_order_date(self) -> DataFrame:
        return self.orders("order_date").agg(F.max("order_date").alias("last_date"))

    def revenue_total(self) -> DataFrame:
        return self.product_totals("revenue_cents").agg(
            F.sum("revenue_cents").alias("total_cents")
        )
