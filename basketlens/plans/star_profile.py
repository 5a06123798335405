"""One pass over the fact table that answers all quality checks.

Every sales line becomes a few entries: its key, its order, and the customer,
product, store and day it points to. Rows of the dimensions are entries of the
same kind, so grouping entries by (kind, key) counts duplicates, shows lines
without their dimension row, and adds up the revenue of a slice, without a join.
Groups are summed once more per kind. The fact is read once, entries are summed
before they are shuffled, so no key is hot, and one row per kind comes back. All
sums are whole numbers, which a hash aggregate can hold; texts are keys only.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.sources.star import Star

_EPOCH = date(1970, 1, 1)
# Column of the fact per kind of key that it points with.
POINTERS = {
    "customer": "customer_key", "product": "product_key", "store": "store_key", "day": "order_date",
}

_COUNTS = ["n", "numbered", "revenue", "parents", "named", "placed"]


def _entry(kind: str, key: Column | None = None, line: Column | None = None,
           text: Column | None = None, **counts: Column | int) -> Column:
    """An entry; what is not given is 0 or null."""

    def of(value: Column | None, kind_: str, name: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind_).alias(name)

    return F.struct(
        F.lit(kind).alias("kind"), of(key, "bigint", "key"), of(line, "bigint", "line"),
        of(text, "string", "text"),
        *[
            (value if isinstance(value := counts.get(c, 0), Column) else F.lit(value)).cast("bigint").alias(c)
            for c in _COUNTS
        ],
    )


def _day_number(column: str) -> Column:
    return F.datediff(F.col(column), F.lit(_EPOCH))


def _dimension_entries(star: Star, slices: bool) -> list[DataFrame]:
    """Entries of the dimension rows, and of the keys by which dimensions point on."""
    one = {"parents": 1}

    def rows(df: DataFrame, *entries: Column) -> DataFrame:
        return df.select(F.explode(F.array(*entries)).alias("e"))

    customers = star.customer_flat("customer_country") if slices else star.table("dim_customer").select("customer_key")
    named = F.when(F.col("customer_country").isNotNull(), 1).otherwise(0) if slices else F.lit(0)
    stores = star.store_flat("channel", "store_country") if slices else star.table("dim_store").select("store_key")
    parts = [
        rows(customers, _entry("customer", F.col("customer_key"), named=named, **one)),
        rows(
            star.table("dim_product").select("product_key", "subcategory_key"),
            _entry("product", F.col("product_key"), **one),
            _entry("subcategory", text=F.col("subcategory_key"), n=1),
        ),
        rows(
            stores,
            _entry(
                "store", F.col("store_key"), **one,
                named=F.when(F.col("channel").isNotNull(), 1).otherwise(0) if slices else 0,
                placed=F.when(F.col("store_country").isNotNull(), 1).otherwise(0) if slices else 0,
            ),
        ),
        rows(
            star.table("dim_subcategory").select("subcategory_key", "category_key"),
            _entry("subcategory", text=F.col("subcategory_key"), **one),
            _entry("category", text=F.col("category_key"), n=1),
        ),
        rows(star.table("dim_category").select("category_key"), _entry("category", text=F.col("category_key"), **one)),
    ]
    if slices:
        named = F.when(F.col("category_name").isNotNull(), 1).otherwise(0)
        parts.append(
            rows(star.product_flat("category_name"), _entry("product", F.col("product_key"), named=named))
        )
    if not star.derived_calendar:
        parts.append(rows(star.table("dim_date").select("date_key"), _entry("day", _day_number("date_key"), **one)))
    return parts


def _line_entries(star: Star, keys: bool, conditions: Mapping[str, tuple[list[str], Column]], revenue: bool) -> DataFrame:
    pointers = list(POINTERS.values())
    columns = [*(["order_number", "line_item"] if keys else []), *pointers, *(["revenue_cents"] if revenue else [])]
    columns += [c for needed, _ in conditions.values() for c in needed]
    lines = star.fact(*dict.fromkeys(columns))
    # Entries hold keys only; what is counted stays beside them, so the generated
    # code is small enough to be compiled.
    def pointer(kind: str, key: Column, line: Column | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), key.cast("bigint").alias("key"),
            (F.lit(None) if line is None else line).cast("bigint").alias("line"),
        )

    entries = [pointer(kind, _day_number(c) if kind == "day" else F.col(c)) for kind, c in POINTERS.items()]
    if keys:
        entries += [
            pointer("line", F.col("order_number"), F.col("line_item")), pointer("order", F.col("order_number")),
        ]
    flags = [F.when(c, 1).otherwise(0).cast("bigint").alias(f"row {n}") for n, (_, c) in conditions.items()]
    numbered = F.when(F.col("line_item").isNotNull(), 1).otherwise(0) if keys else F.lit(0)
    amount = F.coalesce("revenue_cents", F.lit(0)) if revenue else F.lit(0)
    exploded = lines.select(
        *flags, numbered.cast("bigint").alias("given"), amount.cast("bigint").alias("amount"),
        F.explode(F.array(*entries)).alias("e"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    # What is counted per line is counted on one of its entries.
    first = F.col("e.kind") == "customer"
    return exploded.select(
        "e.*", none.alias("text"), F.lit(1).cast("bigint").alias("n"),
        F.when(F.col("e.kind") == "order", F.col("given")).otherwise(zero).alias("numbered"),
        F.col("amount").alias("revenue"), *[zero.alias(c) for c in ("parents", "named", "placed")],
        *[F.when(first, F.col(f"row {n}")).otherwise(zero).alias(n) for n in conditions],
    )


Numbers = dict[str, dict[str, int | None]]


def star_numbers(
    star: Star, row_checks: Mapping[str, tuple[list[str], Column]] | None = None,
    keys: bool = True, revenue: bool = True,
) -> Numbers:
    """Counts per kind: customer, product, store, day, line, order, subcategory, category.

    ``row_checks`` are (columns, condition) of which the lines are counted, under
    kind ``rows``. One job; the result has a row per kind.
    """
    conditions = dict(row_checks or {})
    dimensions = [d.select("e.*") for d in _dimension_entries(star, revenue)]
    parts = [_line_entries(star, keys, conditions, revenue), *dimensions]
    entries = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    sums = [*_COUNTS, *conditions]
    groups = entries.groupBy("kind", "key", "line", "text").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums],
    )
    keyed = F.col("key").isNotNull() | F.col("text").isNotNull()
    held = F.col("parents") > 0

    def total(value: Column, when: Column | None = None) -> Column:
        return F.coalesce(F.sum(value if when is None else F.when(when, value).otherwise(0)), F.lit(0))

    per_kind = groups.groupBy("kind").agg(
        total(F.col("n")).alias("n"),
        # Entries of the fact without a dimension row; nothing points to a null key.
        total(F.col("n"), ~(keyed & held)).alias("orphans"),
        total(F.col("n"), ~keyed).alias("keyless"),
        # Dimension rows beyond one per key; a row without a key is one too many.
        total(F.col("parents") - F.when(keyed, 1).otherwise(0), held).alias("excess"),
        total(F.col("parents") - 1, held).alias("surplus"),
        total(F.lit(1), F.col("parents") > 1).alias("repeated"),
        total(F.col("parents")).alias("parents"),
        total(F.col("n") - 1, F.col("n") > 0).alias("copies"),
        total(F.lit(1), F.col("key").isNotNull() & F.col("line").isNotNull()).alias("whole"),
        total(F.lit(1), (F.col("n") > 0) & (F.col("numbered") < 1)).alias("unnumbered"),
        F.sum("revenue").alias("revenue"),
        total(F.col("revenue"), F.col("key").isNotNull()).alias("dated"),
        total(F.col("revenue") * F.col("named"), keyed).alias("named"),
        total(F.col("revenue") * F.col("placed"), keyed).alias("placed"),
        F.min("key").alias("first"), F.max("key").alias("last"),
        *[total(F.col(c)).alias(f"row {c}") for c in conditions],
    )
    found: Numbers = {r["kind"]: r.asDict() for r in per_kind.collect()}
    empty = {c: None if c in ("revenue", "first", "last") else 0 for c in per_kind.columns[1:]}
    for kind in (*POINTERS, "line", "order", "subcategory", "category"):
        found.setdefault(kind, dict(empty))
    found["rows"] = {c: sum(v[f"row {c}"] for k, v in found.items() if k != "rows") for c in conditions}
    if star.derived_calendar:
        _calendar_of(star, found["day"])
    return found


def _calendar_of(star: Star, days: dict[str, int | None]) -> None:
    """A calendar made from the fact's own days needs no reading: its span is known here."""
    first, last = days["first"], days["last"]
    if first is not None:
        days["parents"] = last - first + 1
        star.remember_span(*(_EPOCH + timedelta(days=d) for d in (first, last)))
    # Lines without a day are the only ones outside.
    days["orphans"] = days["keyless"]
