"""Data quality checks. Each returns (check_name, observed, threshold, passed).

Counts of violations are compared with a threshold; the frame itself never
raises. ``require_passed`` turns failures into an error after the fact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketlens.functions.scalars import close_to
from basketlens.plans.cleaning import clean_products, clean_sales
from basketlens.plans.star_profile import Numbers, star_numbers
from basketlens.sources.raw_files import RAW_SCHEMAS, unreadable
from basketlens.sources.star import Star

RECOMPUTE_TOLERANCE = 1e-6
RECONCILE_TOLERANCE = 0.01


class QualityError(AssertionError):
    """Some checks failed."""


def require_passed(checks: DataFrame) -> None:
    """Raise with the failing checks, if any (a few rows at most)."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r.check_name}: {r.observed}" for r in failed))


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def _zero(name: str | Column, observed: str | Column) -> list[Column]:
    """Columns of a check that passes when nothing was found."""
    label = F.lit(name) if isinstance(name, str) else name
    value = F.coalesce(F.col(observed) if isinstance(observed, str) else observed, F.lit(0))
    return [
        label.alias("check_name"),
        value.cast("double").alias("observed"),
        F.lit(0.0).alias("threshold"),
        (value == 0).alias("passed"),
    ]


Result = tuple[str, float | None, float, bool | None]
RESULT = "check_name string, observed double, threshold double, passed boolean"


def _none_of(name: str, found: int) -> Result:
    """A check that passes when nothing was found."""
    return name, float(found), 0.0, found == 0


def _results(star: Star, rows: list[Result]) -> DataFrame:
    return star.spark.createDataFrame(rows, RESULT)


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


# -- checks over single rows: any number of them costs one pass ----------------

ROW_CHECKS = {
    "order_date_valid": (["order_date"], lambda: F.col("order_date").isNull()),
    "delivery_before_order": (
        ["order_date", "delivery_date"],
        lambda: F.col("delivery_date") < F.col("order_date"),
    ),
    "quantity_valid": (
        ["quantity"], lambda: F.col("quantity").isNull() | (F.col("quantity") <= 0)
    ),
    "revenue_recompute": (
        ["quantity", "unit_price_usd", "revenue_usd"],
        lambda: ~close_to(
            F.col("quantity") * F.col("unit_price_usd"), "revenue_usd", RECOMPUTE_TOLERANCE
        ),
    ),
    "negative_profit": (["profit_usd"], lambda: F.col("profit_usd") < 0),
    # A CHECK constraint lets a null pass.
    "check_quantity_constraint": (["quantity"], lambda: F.col("quantity") <= 0),
}


def row_checks(star: Star, names: list[str] | None = None) -> DataFrame:
    names = names or list(ROW_CHECKS)
    needed = list(dict.fromkeys(c for n in names for c in ROW_CHECKS[n][0]))
    counts = star.fact(*needed).agg(*[_count_if(ROW_CHECKS[n][1]()).alias(n) for n in names])
    rows = counts.unpivot([], names, "check_name", "found")
    return rows.select(*_zero(F.col("check_name"), "found"))


def total_revenue_positive(star: Star) -> DataFrame:
    total = F.col("total_cents").cast("double") / 100.0
    return star.revenue_total().select(
        F.lit("total_revenue_positive").alias("check_name"),
        total.alias("observed"),
        F.lit(0.0).alias("threshold"),
        F.coalesce(total > 0, F.lit(False)).alias("passed"),
    )


# -- products ------------------------------------------------------------------


def price_valid(star: Star) -> DataFrame:
    bad = _count_if(F.col("unit_price_usd").isNull() | (F.col("unit_price_usd") < 0))
    return star.table("dim_product").agg(bad.alias("n")).select(*_zero("price_valid", "n"))


def cost_valid(star: Star) -> DataFrame:
    bad = _count_if(F.col("unit_cost_usd").isNull() | (F.col("unit_cost_usd") < 0))
    return star.table("dim_product").agg(bad.alias("n")).select(*_zero("cost_valid", "n"))


def category_key_1to1(star: Star) -> DataFrame:
    """Category keys carrying more than one label."""
    labels = star.product_flat("category_key", "category_name")
    per_key = labels.groupBy("category_key").agg(F.count_distinct("category_name").alias("k"))
    return per_key.agg(_count_if(F.col("k") > 1).alias("n")).select(
        *_zero("category_key_1to1", "n")
    )


# -- keys ----------------------------------------------------------------------


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key, one row one column. Nulls are equal."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    return groups.agg(F.sum(F.col("k") - 1).alias("n"))


def dup_transaction_key(star: Star) -> DataFrame:
    keys = ["order_number", "line_item"]
    return surplus_rows(star.fact(*keys), keys).select(*_zero("dup_transaction_key", "n"))


def fact_composite_key(star: Star) -> DataFrame:
    """Rows without a key of their own; unlike duplicates, a null in the key counts."""
    keys = ["order_number", "line_item"]
    groups = star.fact(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("k"))
    whole = F.col("order_number").isNotNull() & F.col("line_item").isNotNull()
    excess = F.sum("k") - F.sum(F.when(whole, 1).otherwise(0))
    return groups.agg(excess.alias("n")).select(*_zero("fact_composite_key", "n"))


def customer_key_unique(star: Star) -> DataFrame:
    keys = star.table("dim_customer").select("customer_key")
    return surplus_rows(keys, ["customer_key"]).select(*_zero("customer_key_unique", "n"))


def duplicate_groups(star: Star) -> DataFrame:
    """Customer keys occurring more than once."""
    groups = star.table("dim_customer").groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("k")
    )
    return groups.where("k > 1").agg(F.count(F.lit(1)).alias("n")).select(
        *_zero("duplicate_groups", "n")
    )


# The key of each dimension.
PRIMARY_KEYS = {
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_store": "store_key",
    "dim_category": "category_key",
    "dim_subcategory": "subcategory_key",
    "dim_date": "date_key",
}


def primary_keys(star: Star, tables: list[str] | None = None) -> DataFrame:
    """Rows without a key of their own: duplicates and nulls alike."""
    checks = []
    for table, key in PRIMARY_KEYS.items():
        if tables is not None and table not in tables:
            continue
        excess = star.table(table).agg(
            (F.count(F.lit(1)) - F.count_distinct(key)).alias("n")
        )
        checks.append(excess.select(*_zero(f"{table}.{key}", "n")))
    return union_checks(checks)


def order_has_lines(star: Star) -> DataFrame:
    """Orders without a single line number."""
    per_order = star.fact("order_number", "line_item").groupBy("order_number").agg(
        F.count("line_item").alias("k")
    )
    return per_order.agg(_count_if(F.col("k") < 1).alias("n")).select(
        *_zero("order_has_lines", "n")
    )


# -- references ----------------------------------------------------------------


def orphans(weights: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent, from one weighted row per key."""
    return weights.join(parent.select(key), key, "left_anti").agg(F.sum("w").alias("n"))


def _weights(df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(key).agg(rows.alias("w"))


def orphan_customer(star: Star, name: str = "orphan_customer") -> DataFrame:
    weights = _weights(star.orders("customer_key", "n_lines"), "customer_key", "n_lines")
    return orphans(weights, star.table("dim_customer"), "customer_key").select(*_zero(name, "n"))


# The relationships and the kind of key that each one counts.
RELATIONSHIPS = {
    "fact_sales.customer_key": "customer",
    "fact_sales.product_key": "product",
    "fact_sales.store_key": "store",
    "fact_sales.order_date": "day",
    "dim_product.subcategory_key": "subcategory",
    "dim_subcategory.category_key": "category",
}


def foreign_keys(star: Star, numbers: Numbers | None = None) -> DataFrame:
    """Orphans of the six relationships and their sum."""
    numbers = numbers or star_numbers(star, keys=False, revenue=False)
    return _results(star, _reference_rows(numbers))


def _reference_rows(numbers: Numbers) -> list[Result]:
    found = {name: numbers[kind]["orphans"] for name, kind in RELATIONSHIPS.items()}
    return [_none_of(n, v) for n, v in {**found, "all_foreign_keys": sum(found.values())}.items()]


# -- files -------------------------------------------------------------------------


def unreadable_cells(cells: Mapping[str, DataFrame]) -> DataFrame:
    """Cells of each raw table that hold something, but not a value of their type."""
    tables = [n for n in RAW_SCHEMAS if n in cells]
    return union_checks(
        [unreadable(cells[n], RAW_SCHEMAS[n]).select(*_zero(n, "n")) for n in tables]
    )


# -- totals --------------------------------------------------------------------

# The raw table behind each star table.
SOURCES = {
    "dim_customer": "customers",
    "dim_product": "products",
    "dim_store": "stores",
    "exchange_rate": "exchange_rates",
    "fact_sales": "sales",
}


def row_counts(star: Star, raw: Mapping[str, DataFrame], without: Sequence[str] = ()) -> DataFrame:
    """Rows of a star table minus rows of the raw table it came from."""
    checks = []
    for table, source in SOURCES.items():
        if table in without:
            continue
        signed = star.table(table).select(F.lit(1).alias("s")).unionAll(
            raw[source].select(F.lit(-1).alias("s"))
        )
        checks.append(signed.agg(F.sum("s").alias("n")).select(*_zero(table, "n")))
    return union_checks(checks)


def revenue_reconciles(star: Star, sales: DataFrame) -> DataFrame:
    """Star revenue against the clean sales table, within a cent."""
    other = sales.agg(F.sum("revenue_usd").cast("double").alias("t"))
    ours = star.revenue_total().select((F.col("total_cents").cast("double") / 100.0).alias("t"))
    gap = F.abs(F.col("t") - other.scalar())
    return ours.select(gap.alias("gap")).select(
        F.lit("revenue_reconciles").alias("check_name"),
        F.col("gap").alias("observed"),
        F.lit(RECONCILE_TOLERANCE).alias("threshold"),
        F.coalesce(F.col("gap") < RECONCILE_TOLERANCE, F.lit(False)).alias("passed"),
    )


SLICES = ["year", "customer_country", "category_name", "channel", "store_country"]


def slice_reconciliation(star: Star, numbers: Numbers | None = None) -> DataFrame:
    """Revenue summed over each slicing against the total; the gap is reported."""
    numbers = numbers or star_numbers(star, keys=False)
    return _results(star, _slice_rows(numbers))


def _total_cents(numbers: Numbers) -> int | None:
    lines = numbers["customer"]
    return lines["revenue"] if lines["n"] else None


def _slice_rows(numbers: Numbers) -> list[Result]:
    sums = {
        "year": numbers["day"]["dated"],
        "customer_country": numbers["customer"]["named"],
        "category_name": numbers["product"]["named"],
        "channel": numbers["store"]["named"],
        "store_country": numbers["store"]["placed"],
    }
    total = _total_cents(numbers)
    rows: list[Result] = []
    for name in SLICES:
        gap = None if total is None else abs(sums[name] - total) / 100.0
        rows.append((name, gap, RECONCILE_TOLERANCE, None if gap is None else gap < RECONCILE_TOLERANCE))
    return rows


# -- suites --------------------------------------------------------------------

CLEAN_ROWS = [
    "order_date_valid", "delivery_before_order", "quantity_valid", "revenue_recompute",
    "negative_profit",
]


def suite_numbers(star: Star) -> Numbers:
    """What both suites need of the star, from one pass over its fact table."""
    return star_numbers(star, {n: (ROW_CHECKS[n][0], ROW_CHECKS[n][1]()) for n in CLEAN_ROWS})


def clean_suite(star: Star, numbers: Numbers | None = None) -> DataFrame:
    """The thirteen checks run on the cleaned tables.

    ``numbers`` may hand over what ``suite_numbers`` found; else the fact is
    read here, once.
    """
    numbers = numbers or suite_numbers(star)
    total = _total_cents(numbers)
    revenue = None if total is None else total / 100.0
    counted = [
        _none_of("dup_transaction_key", numbers["line"]["copies"]),
        *[_none_of(n, numbers["rows"][n]) for n in CLEAN_ROWS],
        _none_of("customer_key_unique", numbers["customer"]["surplus"]),
        _none_of("orphan_customer", numbers["customer"]["orphans"]),
        _none_of("order_has_lines", numbers["order"]["unnumbered"]),
        ("total_revenue_positive", revenue, 0.0, bool(revenue and revenue > 0)),
    ]
    return union_checks(
        [_results(star, counted), price_valid(star), cost_valid(star), category_key_1to1(star)]
    )


def star_suite(
    star: Star, raw: Mapping[str, DataFrame], sales: DataFrame | None = None,
    numbers: Numbers | None = None,
) -> DataFrame:
    """The twenty-one checks run on the finished star.

    The raw sales are read once: their rows are counted as they pass by on the
    way to the clean sales, whose revenue is compared. ``sales`` may name other
    clean sales to compare with, ``numbers`` as in ``clean_suite``.
    """
    numbers = numbers or star_numbers(star)
    lines = numbers["line"]
    keys = [_none_of(f"{t}.{PRIMARY_KEYS[t]}", numbers[k]["excess"]) for t, k in _KEY_KINDS.items()]
    counts, theirs = _raw_sales(raw, sales)
    total = _total_cents(numbers)
    gap = None if total is None or theirs is None else abs(total / 100.0 - theirs)
    rows = [
        _none_of("fact_sales", lines["n"] - counts),
        *keys,
        _none_of("fact_composite_key", lines["n"] - lines["whole"]),
        *_reference_rows(numbers),
        _none_of("duplicate_groups", numbers["customer"]["repeated"]),
        ("revenue_reconciles", gap, RECONCILE_TOLERANCE, gap is not None and gap < RECONCILE_TOLERANCE),
    ]
    return union_checks([row_counts(star, raw, without=["fact_sales"]), _results(star, rows)])


_KEY_KINDS = {
    "dim_customer": "customer", "dim_product": "product", "dim_store": "store",
    "dim_category": "category", "dim_subcategory": "subcategory", "dim_date": "day",
}


def _raw_sales(raw: Mapping[str, DataFrame], sales: DataFrame | None) -> tuple[int, float | None]:
    """Rows of the raw sales, and revenue of the clean sales made of them."""
    if sales is not None:
        revenue = sales.agg(F.sum("revenue_usd").cast("double").alias("t")).first()["t"]
        return raw["sales"].count(), revenue
    seen = Observation("raw sales")
    observed = raw["sales"].observe(seen, F.count(F.lit(1)).alias("n"))
    made = clean_sales(observed, clean_products(raw["products"]))
    revenue = made.agg(F.sum("revenue_usd").cast("double").alias("t")).first()["t"]
    return seen.get["n"], revenue
