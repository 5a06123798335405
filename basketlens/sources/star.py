"""The sales star schema and the denormalised views the plans read.

Plans never join by hand. They ask a star for columns by name and get a frame
with exactly those, so only the tables that own a requested column are read
and joined.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.functions.scalars import AMOUNT, MONEY, RATE
from basketlens.operators.joins import is_large, lookup_join
from basketlens.sources.raw_files import read_csv, write_table
from basketlens.sources.versions import Versions

TABLES = [
    "dim_category", "dim_subcategory", "dim_product", "dim_customer",
    "dim_store", "dim_date", "exchange_rate", "fact_sales",
]

# The customers' scores and segments, which are made from the star.
SEGMENTS = "customer_rfm"

# Partition column of a stored fact table.
STORED_YEAR = "order_year"

# Tells order lines apart.
LINE_IDENTITY = ["order_number", "line_item"]

FACT_COLUMNS = [
    "order_number", "line_item", "order_date", "delivery_date", "is_delivered",
    "customer_key", "store_key", "product_key", "quantity", "currency_code",
    "unit_price_usd", "unit_cost_usd", "revenue_usd", "cost_usd", "profit_usd",
]

# Amounts in whole cents, derived from the decimal columns.
CENT_COLUMNS = {
    "revenue_cents": "revenue_usd",
    "cost_cents": "cost_usd",
    "profit_cents": "profit_usd",
}

PRODUCT_COLUMNS = [
    "product_name", "brand", "color", "subcategory_key", "subcategory_name",
    "category_key", "category_name",
]

# Name in a denormalised view -> column of the dimension.
STORE_COLUMNS = {
    "store_country": "country", "store_state": "state",
    "square_meters": "square_meters", "open_date": "open_date",
    "is_online": "is_online",
    "channel": "CASE WHEN is_online THEN 'Online' ELSE 'In-Store' END",
}
CUSTOMER_COLUMNS = {
    "customer_name": "name", "customer_country": "country",
    "customer_state": "state", "continent": "continent", "gender": "gender",
    "birthday": "birthday",
    # Of the customer's scores; there once ``with_segments`` has told them.
    "segment": "segment",
}


def _matched(hits: list[str], wanted: bool) -> list[str]:
    return [f"({' AND '.join(hits or ['true'])}) AS matched"] if wanted else []


# Attributes computed from ``order_date``; no calendar join is needed.
DATE_COLUMNS = {
    "year": "year(order_date)",
    "quarter": "quarter(order_date)",
    "month": "month(order_date)",
    "year_month": "date_format(order_date, 'yyyy-MM')",
    "month_start": "trunc(order_date, 'MM')",
    # Months since year 0; differences of it are month differences.
    "month_index": "year(order_date) * 12 + month(order_date) - 1",
    "weekday": "weekday(order_date)",
    "day_name": "date_format(order_date, 'EEEE')",
}


def _named(cols: tuple[str, ...] | list[str], exprs: dict[str, str]) -> list[str]:
    return [f"{exprs[c]} AS {c}" if c in exprs else c for c in cols]


def calendar(first: Column, last: Column) -> list[Column]:
    """Select list turning one row into one row per day of [first, last]."""
    return [F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key")]


def with_date_parts(days: DataFrame) -> DataFrame:
    return days.selectExpr(
        "date_key",
        "year(date_key) AS year",
        "quarter(date_key) AS quarter",
        "month(date_key) AS month",
        "date_format(date_key, 'MMMM') AS month_name",
        "day(date_key) AS day",
        "weekday(date_key) AS day_of_week",
        "date_format(date_key, 'EEEE') AS day_name",
        "weekday(date_key) >= 5 AS is_weekend",
    )


def fixed_calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Date dimension over a given span instead of the span of the orders."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b")
    )
    return with_date_parts(bounds.select(*calendar(F.col("a"), F.col("b"))))


class Star:
    """A star schema held as eight DataFrames."""

    # Whether every order row belongs to one customer. Loaded data need not.
    one_customer_per_order = False
    # Whether the calendar is made from the fact's own days when it is asked for.
    derived_calendar = False

    def __init__(self, tables: dict[str, DataFrame]):
        self._tables = tables
        # A stored fact is partitioned by year; asking for that column lets a
        # filter on the year skip whole partitions.
        facts = tables.get("fact_sales")
        self._year_stored = facts is not None and STORED_YEAR in facts.columns

    @property
    def spark(self) -> SparkSession:
        return self.table("fact_sales").sparkSession

    def table(self, name: str) -> DataFrame:
        return self._tables[name]

    # -- views ---------------------------------------------------------------

    def _date_columns(self) -> dict[str, str]:
        return {**DATE_COLUMNS, "year": STORED_YEAR} if self._year_stored else DATE_COLUMNS

    def _date_sources(self, names: list[str]) -> list[str]:
        """Fact columns the given date attributes are computed from."""
        stored = {"year"} if self._year_stored else set()
        sources = [STORED_YEAR if n in stored else "order_date" for n in names]
        return list(dict.fromkeys(sources))

    def product_flat(self, *cols: str) -> DataFrame:
        """Products with their subcategory and category names (inner chain)."""
        flat = self.table("dim_product")
        if {"subcategory_name", "category_key", "category_name"} & set(cols):
            flat = flat.join(self.table("dim_subcategory"), "subcategory_key")
        if "category_name" in cols:
            flat = flat.join(self.table("dim_category"), "category_key")
        return flat.select("product_key", *cols)

    def store_flat(self, *cols: str) -> DataFrame:
        return self.table("dim_store").selectExpr("store_key", *_named(cols, STORE_COLUMNS))

    def customer_flat(self, *cols: str) -> DataFrame:
        customers = self.table("dim_customer")
        if "segment" in cols:
            if SEGMENTS not in self._tables:
                raise ValueError("no segments are known; see with_segments")
            # A row per customer on both sides. Customers without orders have none.
            scored = self.table(SEGMENTS).select("customer_key", "segment")
            customers = customers.join(scored, "customer_key", "left")
        return customers.selectExpr("customer_key", *_named(cols, CUSTOMER_COLUMNS))

    def with_segments(self, segments: DataFrame) -> Star:
        """This star with the segment of each customer as an attribute of the customer.

        ``segments`` has a row per customer with ``customer_key`` and ``segment``.
        """
        known = copy.copy(self)
        known._tables = {**self._tables, SEGMENTS: segments}
        return known

    def fact(self, *cols: str) -> DataFrame:
        """Fact columns, with the ``*_cents`` amounts available by name."""
        cents = {c: f"CAST({usd} * 100 AS BIGINT)" for c, usd in CENT_COLUMNS.items()}
        return self.table("fact_sales").selectExpr(*_named(cols, cents))

    def key_rows(self, key: str) -> DataFrame:
        """A frame whose row counts per ``key`` resemble those of the fact."""
        return self.fact(key)

    def look_up(self, facts: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
        """Lookup join that finds hot keys in the stored fact's key column, so
        earlier joins of ``facts`` are not run for it. Hot keys are cut by the
        line's identity where ``facts`` carries it."""
        identity = LINE_IDENTITY if set(LINE_IDENTITY) <= set(facts.columns) else []
        return lookup_join(facts, dim, key, how, lambda: self.key_rows(key), identity=identity)

    def fact_with_product(
        self, fact_cols: list[str], product_cols: list[str], how: str = "inner"
    ) -> DataFrame:
        """Fact lines with product columns; a left join also gets ``_product``,
        which is null where there is no product."""
        products = self.product_flat(*product_cols)
        identity = LINE_IDENTITY if is_large(products) else []
        facts = self.fact(*dict.fromkeys([*fact_cols, "product_key", *identity]))
        if how == "left":
            products = products.selectExpr("*", "true AS _product")
        return self.look_up(facts, products, "product_key", how)

    def lines(self, *cols: str, unmatched: bool = False) -> DataFrame:
        """One row per order line with fact, date and dimension attributes.

        Dimension joins are inner: a line without its dimension row is left
        out, as in a report that names the dimension. With ``unmatched`` such
        lines stay, and a flag ``matched`` tells them apart; a share of the
        whole fact table then needs no second scan.
        """
        product_cols = [c for c in cols if c in PRODUCT_COLUMNS]
        store_cols = [c for c in cols if c in STORE_COLUMNS]
        customer_cols = [c for c in cols if c in CUSTOMER_COLUMNS]
        date_cols = [c for c in cols if c in DATE_COLUMNS]
        fact_cols = [c for c in cols if c in FACT_COLUMNS or c in CENT_COLUMNS]
        unknown = set(cols) - {
            *product_cols, *store_cols, *customer_cols, *date_cols, *fact_cols
        }
        if unknown:
            raise ValueError(f"unknown columns: {sorted(unknown)}")
        fact_cols.extend(self._date_sources(date_cols))
        if store_cols:
            fact_cols.append("store_key")
        if customer_cols:
            fact_cols.append("customer_key")
        if (store_cols and is_large(self.store_flat())) or (
            customer_cols and is_large(self.customer_flat())
        ):
            fact_cols.extend(LINE_IDENTITY)
        fact_cols = list(dict.fromkeys(fact_cols))
        how = "left" if unmatched else "inner"
        hits = []
        if product_cols:
            df = self.fact_with_product(fact_cols, product_cols, how)
            hits.append("_product IS NOT NULL")
        else:
            df = self.fact(*fact_cols)
        if store_cols:
            stores = self.store_flat(*store_cols).selectExpr("*", "true AS _store")
            df = self.look_up(df, stores, "store_key", how)
            hits.append("_store IS NOT NULL")
        if customer_cols:
            customers = self.customer_flat(*customer_cols).selectExpr("*", "true AS _customer")
            df = self.look_up(df, customers, "customer_key", how)
            hits.append("_customer IS NOT NULL")
        return df.selectExpr(*_named(cols, self._date_columns()), *_matched(hits, unmatched))

    def orders(self, *cols: str, unmatched: bool = False) -> DataFrame:
        """Fact pre-aggregated to the order.

        ``cols`` may name order attributes (``customer_key``, ``order_date``),
        date and customer attributes, and the totals ``revenue_cents``,
        ``quantity`` and ``n_lines``. Rows are distinct in the attributes, so
        every later distinct count or sum is the same as over the lines.
        ``unmatched`` works as in ``lines``.
        """
        customer_cols = [c for c in cols if c in CUSTOMER_COLUMNS]
        keys = {"order_number"}
        if customer_cols or "customer_key" in cols:
            keys.add("customer_key")
        keys.update(self._date_sources([c for c in cols if c in DATE_COLUMNS]))
        if "order_date" in cols:
            keys.add("order_date")
        totals = [c for c in ("revenue_cents", "quantity", "n_lines") if c in cols]
        df = self._order_totals(sorted(keys), totals)
        hits = []
        if customer_cols:
            customers = self.customer_flat(*customer_cols).selectExpr("*", "true AS _customer")
            df = self.look_up(df, customers, "customer_key", "left" if unmatched else "inner")
            hits.append("_customer IS NOT NULL")
        return df.selectExpr(*_named(cols, self._date_columns()), *_matched(hits, unmatched))

    def _order_totals(self, keys: list[str], totals: list[str]) -> DataFrame:
        facts = self.fact(*keys, *[t for t in totals if t != "n_lines"])
        if not totals:
            return facts.distinct()
        return facts.groupBy(*keys).agg(*[_total(t) for t in totals])

    def product_totals(self, *totals: str) -> DataFrame:
        """One row per sold product; joins to its dimension come after this."""
        facts = self.fact("product_key", *[t for t in totals if t != "n_lines"])
        return facts.groupBy("product_key").agg(*[_total(t) for t in totals])

    def line_value_counts(self, value: str, by: list[str] | None = None) -> DataFrame:
        """How often each value of a line column occurs per group: by..., value, ``n``."""
        names = [*(by or []), value]
        rows = self.lines(*names) if by else self.fact(value)
        return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))

    def customers(self, *cols: str) -> DataFrame:
        """One row per purchasing customer: ``orders``, ``revenue_cents``,
        ``first_date``, ``last_date`` as requested."""
        needs = {
            "orders": ("order_number", F.count_distinct),
            "revenue_cents": ("revenue_cents", F.sum),
            "first_date": ("order_date", F.min),
            "last_date": ("order_date", F.max),
        }
        sources = dict.fromkeys(needs[c][0] for c in cols)
        orders = self.orders("customer_key", *sources)
        if not cols:
            return orders.distinct()
        totals = [fn(source).alias(c) for c, (source, fn) in needs.items() if c in cols]
        return orders.groupBy("customer_key").agg(*totals)

    def last_order_date(self) -> DataFrame:
        """One row, one column: the latest order date."""
        return self.fact("order_date").agg(F.max("order_date").alias("last_date"))

    def revenue_total(self) -> DataFrame:
        """One row, one column: revenue of the whole fact table in cents."""
        return self.fact("revenue_cents").agg(F.sum("revenue_cents").alias("total_cents"))


def _total(name: str) -> Column:
    if name == "n_lines":
        return F.count(F.lit(1)).alias(name)
    return F.sum(name).cast("bigint").alias(name)


# -- storage -----------------------------------------------------------------


# Types of the published tables, for formats that don't carry them.
MULTILINE = {"dim_customer", "dim_product"}  # free text may hold line breaks
TABLE_SCHEMAS = {
    "dim_category": "category_key string, category_name string",
    "dim_subcategory": "subcategory_key string, subcategory_name string, category_key string",
    "dim_product": "product_key bigint, product_name string, brand string, color string, "
    "unit_cost_usd {money}, unit_price_usd {money}, subcategory_key string",
    "dim_customer": "customer_key bigint, gender string, name string, city string, "
    "state_code string, state string, zip_code string, country string, continent string, "
    "birthday date",
    "dim_store": "store_key bigint, country string, state string, square_meters double, "
    "open_date date, is_online boolean",
    "dim_date": "date_key date, year int, quarter int, month int, month_name string, day int, "
    "day_of_week int, day_name string, is_weekend boolean",
    "exchange_rate": "rate_date date, currency string, exchange {rate}",
    "fact_sales": "order_number bigint, line_item bigint, order_date date, delivery_date date, "
    "is_delivered boolean, customer_key bigint, store_key bigint, product_key bigint, "
    "quantity int, currency_code string, unit_price_usd {money}, unit_cost_usd {money}, "
    "revenue_usd {amount}, cost_usd {amount}, profit_usd {amount}",
    "customer_rfm": "customer_key bigint, last_order_date date, recency_days int, "
    "frequency bigint, monetary_cents bigint, r_score int, f_score int, m_score int, "
    "fm_score int, rfm_score_label string, segment string",
}
STORED_DATE = "yyyy-MM-dd"


def table_schema(name: str) -> T.StructType:
    """Schema of a published table."""
    ddl = TABLE_SCHEMAS[name].format(money=MONEY, amount=AMOUNT, rate=RATE)
    return T.StructType.fromDDL(ddl)


def read_published_csv(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A published CSV table with its types."""
    path = f"{folder.rstrip('/')}/{name}"
    return read_csv(spark, path, table_schema(name), date_format=STORED_DATE, line_breaks=name in MULTILINE)


def write_star(star: Star, folder: str, fmt: str = "parquet") -> None:
    """Store the eight tables; as Parquet the fact is partitioned by year.

    Readers see the tables together once all are written; if one fails, they go
    on reading the star that was there before.
    """
    versions = Versions(star.spark, folder)
    version = versions.new()
    try:
        for name in TABLES:
            _write_star_table(star.table(name), name, f"{versions.path(version)}/{name}", fmt)
    except BaseException:
        versions.drop(version)
        raise
    versions.publish(version)


def _write_star_table(df: DataFrame, name: str, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_table(df.select(*table_schema(name).names), path, fmt)
    elif name == "fact_sales":
        # Rebalancing gives each year files of even size, and splits a year
        # that holds much of the data.
        by_year = df.withColumn(STORED_YEAR, F.year("order_date"))
        by_year.hint("rebalance", STORED_YEAR).write.partitionBy(STORED_YEAR).parquet(path)
    else:
        df.write.parquet(path)


def read_star(spark: SparkSession, folder: str, fmt: str = "parquet") -> Star:
    """Open the tables that write_star wrote last."""
    root = Versions(spark, folder).current()
    if fmt == "csv":
        return Star({n: read_published_csv(spark, root, n) for n in TABLES})
    return Star({n: spark.read.parquet(f"{root}/{n}") for n in TABLES})


def register_views(star: Star) -> None:
    """Expose the tables to ``spark.sql`` under their names."""
    for name in TABLES:
        star.table(name).createOrReplaceTempView(name)
