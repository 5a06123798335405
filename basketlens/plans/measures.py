"""KPI measures that evaluate under any grouping and filter.

Each measure has one definition here. ``measures_by`` computes any set of them
for the groups named by ``dims`` among the sales that pass ``filters``, and
reads only the tables owning the columns involved.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.functions.scalars import percent2, usd, usd_per
from basketlens.operators.distinct import bit_of, word_of
from basketlens.operators.distribution import MEDIAN, Distribution
from basketlens.sources.star import CUSTOMER_COLUMNS, DATE_COLUMNS, Star

# Measure -> building blocks it is made of.
BLOCKS = {
    "total_revenue": ["r"],
    "total_orders": ["o"],
    "total_customers": ["c"],
    "units_sold": ["q"],
    "average_order_value": ["r", "o"],
    "median_order_value": ["median"],
    "revenue_per_customer": ["r", "c"],
    "historical_clv": ["r", "c"],
    "revenue_yoy_growth_pct": ["current", "prior"],
    "yoy_period_complete": ["current", "prior"],
    "repeat_customers": ["ever"],
    "repeat_customers_in_context": ["again"],
    "repeat_purchase_rate_pct": ["ever", "c"],
    "new_customers": ["new"],
}


def _formula(measure: str) -> Column:
    """Measure from its building blocks; ratios round at the very end."""
    per_customer = usd_per("r", "c")
    return {
        "total_revenue": usd("r"),
        "total_orders": F.col("o"),
        "total_customers": F.col("c"),
        "units_sold": F.col("q"),
        "average_order_value": usd_per("r", "o"),
        "median_order_value": F.round(F.col("median") / F.lit(100.0), 4),
        "revenue_per_customer": per_customer,
        # Realised average over the period; not a prediction.
        "historical_clv": per_customer,
        # No sales a year earlier: blank. Sales then but none now: -100.
        "revenue_yoy_growth_pct": percent2(F.coalesce("current", F.lit(0)) - F.col("prior"), "prior"),
        # Whether the period ends by the last order, so both years cover it alike.
        "yoy_period_complete": F.col("whole"),
        "repeat_customers": F.col("ever"),
        "repeat_customers_in_context": F.col("again"),
        "repeat_purchase_rate_pct": percent2("ever", "c"),
        "new_customers": F.col("new"),
    }[measure]


Filters = dict[str, object]


def _values(wanted: object) -> list:
    return list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]


def _condition(column: str, wanted: object) -> Column:
    return F.col(column).isin(_values(wanted))


# Columns that a sale has at order grain.
ORDER_LEVEL = {
    *DATE_COLUMNS, *CUSTOMER_COLUMNS, "order_number", "customer_key", "order_date",
    "revenue_cents", "quantity",
}


def _rows(star: Star, cols: list[str], filters: Filters) -> DataFrame:
    """Sales with ``cols``, at order grain where no column needs the lines."""
    wanted = list(dict.fromkeys([*cols, *filters]))
    view = star.orders if set(wanted) <= ORDER_LEVEL else star.lines
    df = view(*wanted)
    for column, value in filters.items():
        df = df.where(_condition(column, value))
    return df.select(*cols)


def _sales_blocks(star: Star, dims: list[str], filters: Filters, need: set[str]) -> list[DataFrame]:
    """Totals, order counts and customer counts.

    Sales are reduced once to (group, customer, order). Orders and customers
    are then counted from that. When both are wanted, both carry the totals:
    they read the same columns, so Spark runs the reduction once and reuses
    its exchange.
    """
    by_order = bool(need & {"r", "q", "o"})
    by_customer = bool(need & {"c", "again"})
    totals = {"r": "revenue_cents", "q": "quantity"}
    totals = {n: c for n, c in totals.items() if n in need}
    keys = [*dims, "order_number", *(["customer_key"] if by_customer else [])]
    base = _rows(star, [*keys, *[c for c in totals.values() if c not in keys]], filters)
    sums = [F.sum(c).alias(n) for n, c in totals.items()]
    reduced = base.groupBy(*keys).agg(*sums) if sums else base.distinct()
    again = [F.sum(n).alias(n) for n in totals]
    blocks = []
    if by_order:
        # Without customers a group has one row per order already; counting it again
        # as distinct would hold every order in two more hash maps of a task.
        counted = F.count_distinct("order_number") if by_customer else F.count("order_number")
        orders = [counted.alias("o")] if "o" in need else []
        blocks.append(reduced.groupBy(*dims).agg(*orders, *again))
    if not by_customer:
        return blocks
    per_customer = reduced.groupBy(*dims, "customer_key").agg(
        F.count("order_number").alias("n_here"), *again
    )
    key = F.col("customer_key")
    conditions = {"c": key, "again": F.when(F.col("n_here") >= 2, key)}
    counts = [F.count(counted).alias(n) for n, counted in conditions.items() if n in need]
    blocks.append(per_customer.groupBy(*dims).agg(*counts, *again))
    return blocks


_EPOCH = "1970-01-01"
_SALES = {"r", "q", "o", "c", "again", "ever", "new"}
_HISTORY = {"ever", "new"}
_GROWTH = {"current", "prior"}


def _state_entries(
    star: Star, dims: list[str], filters: Filters, need: set[str]
) -> DataFrame:
    """What a sales row adds to the state: its customer's, its order's and its day's part.

    Entries have a kind (``c``, ``o``, ``d``), a flag ``inside`` (the row passes the
    filters), the dims and a key. Purchase history and the last day are taken over
    all sales, so rows that fail the filters, or have no row in a dimension that
    is named, stay as history of their customer. A day's revenue passes without
    the filters on dates, as it also counts one year later.
    """
    by_customer = bool(need & {"c", "again", *_HISTORY})
    growing = bool(need & _GROWTH)
    facts = {"order_date"} if growing or "new" in need else set()
    facts |= {"revenue_cents"} if growing or "r" in need else set()
    facts |= {"quantity"} if "q" in need else set()
    facts |= {"order_number"} if need & {"o", "again", "ever"} else set()
    facts |= {"customer_key"} if by_customer else set()
    wanted = list(dict.fromkeys([*dims, *filters, *sorted(facts)]))
    view = star.orders if set(wanted) <= ORDER_LEVEL else star.lines
    rows = view(*wanted, unmatched=True)

    def passes(names: list[str]) -> Column:
        conditions = [F.coalesce(_condition(n, filters[n]), F.lit(False)) for n in names]
        return reduce(Column.__and__, conditions, F.col("matched"))

    def value(name: str, kind: str = "bigint") -> Column:
        return (F.col(name) if name in facts else F.lit(None)).cast(kind)

    def entry(kind: str, inside: Column, held: list[str], key: Column, bits: Column | None = None,
              revenue: bool = True) -> Column:
        nothing = F.lit(None)
        return F.struct(
            F.lit(kind).alias("kind"), inside.alias("inside"),
            *[F.when(inside, F.col(d) if d in held else nothing).cast(types[d]).alias(d) for d in dims],
            key.cast("bigint").alias("key"),
            (F.when(inside, value("revenue_cents")) if revenue else nothing.cast("bigint")).alias("r"),
            (F.when(inside, value("quantity")) if kind == "c" else nothing.cast("bigint")).alias("q"),
            (nothing if bits is None else bits).cast("bigint").alias("bits"),
            *[(value(c, k) if kind == "c" else nothing.cast(k)).alias(n)
              for n, c, k in (("order", "order_number", "bigint"), ("day", "order_date", "date"))],
        )

    types = dict(rows.dtypes)
    inside = passes(list(filters))
    entries = [entry("c", inside, dims, F.col("customer_key") if by_customer else F.lit(None))]
    if "o" in need:
        order = F.col("order_number")
        counted = entry("o", F.lit(True), dims, word_of(order), bit_of(order), revenue=False)
        entries.append(F.when(inside & order.isNotNull(), counted))
    if growing:
        dated = passes([f for f in filters if f not in DATE_COLUMNS]) & F.col("order_date").isNotNull()
        day = F.datediff(F.col("order_date"), F.lit(_EPOCH).cast("date"))
        others = [d for d in dims if d not in DATE_COLUMNS]
        entries.append(F.when(dated, entry("d", F.lit(True), others, day)))
    return rows.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").select("e.*")


def _added(days: str, name: str) -> Column:
    """Sum of a field of an array, null where no element has it."""
    given = F.filter(F.transform(days, lambda d: d[name]), lambda v: v.isNotNull())
    return F.when(F.size(given) > 0, F.aggregate(given, F.lit(0).cast("bigint"), lambda t, v: t + v))


def _one_pass(
    star: Star, dims: list[str], filters: Filters, need: set[str], calendar_end: str | None
) -> DataFrame:
    """Building blocks per group, from one state that merges.

    Per (group, customer): sums, first and last order number, first day. Whether a
    customer has several orders is whether those numbers differ, which merges over
    groups; orders are counted as bits of words. Per (group, day): revenue, which
    counts as current on the day and as prior twelve months later, as long as that
    lies within the calendar. The calendar ends with ``calendar_end`` or else with
    the last order, which is known once the groups are put together; until then a
    group keeps its days, no more than a calendar has.
    """
    state = _state_entries(star, dims, filters, need).groupBy("kind", "inside", *dims, "key").agg(
        F.sum("r").alias("r"), F.sum("q").alias("q"), F.bit_or("bits").alias("bits"),
        F.min("order").alias("low"), F.max("order").alias("high"),
        F.min("day").alias("first"), F.max("day").alias("last"),
    )
    # A customer has a row per group at most, so no key is hot here.
    own = Window.partitionBy("kind", "key")
    if need & _HISTORY:
        state = state.withColumns({
            "ever": F.min("low").over(own) < F.max("high").over(own),
            "since": F.min("first").over(own),
        })
    customer = (F.col("kind") == "c") & F.col("key").isNotNull()
    conditions = {
        "c": F.lit(True),
        "again": F.col("low") < F.col("high"),
        "ever": F.col("ever") if "ever" in need else None,
        "new": F.col("first") == F.col("since") if "new" in need else None,
    }
    if need & _GROWTH:
        shifted = (
            "CASE WHEN kind = 'd' THEN array("
            f"struct(date_add(DATE'{_EPOCH}', CAST(key AS INT)) AS order_date, r AS current, CAST(NULL AS BIGINT) AS prior), "
            f"struct(add_months(date_add(DATE'{_EPOCH}', CAST(key AS INT)), 12) AS order_date, CAST(NULL AS BIGINT) AS current, r AS prior)) "
            "ELSE array(struct(CAST(NULL AS DATE) AS order_date, CAST(NULL AS BIGINT) AS current, CAST(NULL AS BIGINT) AS prior)) END"
        )
        state = state.select("*", F.inline(F.expr(shifted)))
        dated = F.col("kind") == "d"
        kept = [
            F.coalesce(F.expr(DATE_COLUMNS[f]).isin(_values(v)), F.lit(False))
            for f, v in filters.items() if f in DATE_COLUMNS
        ]
        state = state.where(reduce(Column.__and__, kept, F.lit(True)) | ~dated).withColumns({
            d: F.when(dated, F.expr(DATE_COLUMNS[d])).otherwise(F.col(d)) for d in dims if d in DATE_COLUMNS
        })
    own_sales = F.col("kind") == "c"
    totals = [
        F.count(F.when(own_sales, 1)).alias("sales"), F.max("last").alias("last"),
        F.sum(F.when(own_sales, F.col("r"))).alias("r"), F.sum("q").alias("q"),
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias("o"),
        *[F.count(F.when(customer & c, 1)).alias(n) for n, c in conditions.items() if c is not None],
    ]
    if need & _GROWTH:
        day = F.struct("order_date", "current", "prior")
        totals.append(F.collect_list(F.when(F.col("kind") == "d", day)).alias("days"))
    report = state.groupBy("inside", *dims).agg(*totals)
    if need & _GROWTH:
        # Rows of the report and one for all other sales.
        last = F.max("last").over(Window.partitionBy())
        report = report.withColumn("last", last).withColumn(
            "days", F.filter("days", lambda d: d["order_date"] <= (F.lit(calendar_end).cast("date") if calendar_end else F.col("last")))
        )
    sold = F.col("sales") > 0
    blocks = {n: F.when(sold, F.col(n)) for n in ("r", "q", "o", *[k for k, c in conditions.items() if c is not None])}
    exists = sold if need & _SALES else F.lit(False)
    if need & _GROWTH:
        blocks.update({n: _added("days", n) for n in ("current", "prior")})
        blocks["whole"] = F.when(F.size("days") > 0, F.forall("days", lambda d: d["order_date"] <= F.col("last")))
        exists = exists | (F.size("days") > 0)
    return report.where(F.col("inside") & exists).select(*dims, *[c.alias(n) for n, c in blocks.items()])


def _median_block(star: Star, dims: list[str], filters: Filters) -> DataFrame:
    orders = (
        _rows(star, [*dims, "order_number", "revenue_cents"], filters)
        .groupBy(*dims, "order_number")
        .agg(F.sum("revenue_cents").alias("revenue_cents"))
    )
    return Distribution(orders, "revenue_cents", dims).quantiles(MEDIAN).select(*dims, "median")


def measures_by(
    star: Star,
    measures: list[str],
    dims: list[str] | None = None,
    filters: Filters | None = None,
    calendar_end: str | None = None,
) -> DataFrame:
    """Evaluate ``measures`` per combination of ``dims`` under ``filters``.

    ``calendar_end`` is the last day that growth over the year before looks
    at; by default that of the last order.
    """
    dims, filters = list(dims or []), dict(filters or {})
    unknown = [m for m in measures if m not in BLOCKS]
    if unknown:
        raise ValueError(f"unknown measures: {unknown}")
    need = {b for m in measures for b in BLOCKS[m]}
    blocks = []
    if need & (_HISTORY | _GROWTH):
        # All sales are wanted beside those that pass: one state holds both.
        blocks.append(_one_pass(star, dims, filters, need, calendar_end))
    elif need & _SALES:
        blocks.extend(_sales_blocks(star, dims, filters, need))
    if "median" in need:
        blocks.append(_median_block(star, dims, filters))
    # Blocks have one row per group and agree where they share a column.
    # Stacking them and keeping one value per group lines them up without
    # joins, null groups included.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    names = [c for c in stacked.columns if c not in dims]
    merged = stacked.groupBy(*dims).agg(*[F.max(c).alias(c) for c in names])
    return merged.select(*dims, *[_formula(m).alias(m) for m in measures])
