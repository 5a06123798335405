"""The raw export derived from the order tables.

Gives the parsers real input at any scale: prices as ``'$1,060.22 '``, dates
as unpadded ``M/d/yyyy``, original column headers.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.scalars import RAW_DATE_FORMAT
from basketlens.sources.mapped import MappedStar
from basketlens.sources.raw_files import BROKEN


def _date_text(col: str) -> str:
    return f"date_format({col}, '{RAW_DATE_FORMAT}')"


def _money_text(col: str) -> str:
    return f"concat('$', format_number({col}, 2), ' ')"


def raw_sales(star: MappedStar) -> DataFrame:
    return star.fact(
        "order_number", "line_item", "order_date", "delivery_date", "customer_key",
        "store_key", "product_key", "quantity", "currency_code",
    ).selectExpr(
        "order_number AS `Order Number`",
        "line_item AS `Line Item`",
        f"{_date_text('order_date')} AS `Order Date`",
        f"{_date_text('delivery_date')} AS `Delivery Date`",
        "customer_key AS CustomerKey",
        "store_key AS StoreKey",
        "product_key AS ProductKey",
        "quantity AS Quantity",
        "currency_code AS `Currency Code`",
    )


def raw_products(star: MappedStar) -> DataFrame:
    return star.product_flat(
        "product_name", "brand", "color", "unit_cost_usd", "unit_price_usd",
        "subcategory_key", "subcategory_name", "category_key", "category_name",
    ).selectExpr(
        "product_key AS ProductKey",
        "product_name AS `Product Name`",
        "brand AS Brand",
        "color AS Color",
        f"{_money_text('unit_cost_usd')} AS `Unit Cost USD`",
        f"{_money_text('unit_price_usd')} AS `Unit Price USD`",
        "subcategory_key AS SubcategoryKey",
        "subcategory_name AS Subcategory",
        "category_key AS CategoryKey",
        "category_name AS Category",
    )


def raw_customers(star: MappedStar) -> DataFrame:
    return star.table("dim_customer").selectExpr(
        "customer_key AS CustomerKey",
        "gender AS Gender",
        "name AS Name",
        "city AS City",
        "state_code AS `State Code`",
        "state AS State",
        "zip_code AS `Zip Code`",
        "country AS Country",
        "continent AS Continent",
        f"{_date_text('birthday')} AS Birthday",
    )


def raw_stores(star: MappedStar) -> DataFrame:
    return star.table("dim_store").selectExpr(
        "store_key AS StoreKey",
        "country AS Country",
        "state AS State",
        "square_meters AS `Square Meters`",
        f"{_date_text('open_date')} AS `Open Date`",
    )


def raw_exchange_rates(star: MappedStar) -> DataFrame:
    return star.table("exchange_rate").selectExpr(
        f"{_date_text('rate_date')} AS Date",
        "currency AS Currency",
        "CAST(exchange AS DOUBLE) AS Exchange",
    )


def raw_cells(star: MappedStar) -> dict[str, DataFrame]:
    """The raw tables as text cells, each record written as a CSV line and read again."""
    tables = RawTables(star)
    quoting = {"escape": '"', "header": "false"}
    cells = {}
    for name in tables:
        raw = tables[name]
        line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), quoting)
        texts = ", ".join(f"`{c}` STRING" for c in [*raw.columns, BROKEN])
        options = {**quoting, "columnNameOfCorruptRecord": BROKEN}
        cells[name] = raw.select(F.from_csv(line, texts, options).alias("r")).select("r.*")
    return cells


class RawTables(Mapping[str, DataFrame]):
    """The raw tables by name; each plan is built on first use."""

    builders = {
        "sales": raw_sales,
        "customers": raw_customers,
        "products": raw_products,
        "stores": raw_stores,
        "exchange_rates": raw_exchange_rates,
    }

    def __init__(self, star: MappedStar):
        self._star = star
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self.builders[name](self._star)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.builders)

    def __len__(self) -> int:
        return len(self.builders)
