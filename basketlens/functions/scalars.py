"""Column expressions shared by all plans. All stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"
AMOUNT = "decimal(18,2)"
RATE = "decimal(12,6)"

# Date format of the raw files; digits may be unpadded.
RAW_DATE_FORMAT = "M/d/yyyy"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# -- parsing -----------------------------------------------------------------


def parse_money(col: Column | str, dtype: str = MONEY) -> Column:
    """``'$1,060.22 '`` to decimal; anything unreadable becomes null."""
    return F.trim(F.regexp_replace(_c(col), "[$,]", "")).try_cast(dtype)


def parse_raw_date(col: Column | str) -> Column:
    """``'1/31/2019'`` to date; anything unreadable becomes null."""
    return F.try_to_date(F.trim(_c(col)), RAW_DATE_FORMAT)


# -- money -------------------------------------------------------------------
# Amounts travel through the plans as whole cents (bigint). Sums of wide
# decimals leave the long-backed fast path of the aggregate; sums of cents
# stay in it and remain exact.


def to_cents(col: Column | str) -> Column:
    return (_c(col) * F.lit(100)).cast("bigint")


def usd(cents: Column | str) -> Column:
    """Whole cents to dollars as double."""
    return _c(cents).cast("double") / F.lit(100.0)


# -- arithmetic --------------------------------------------------------------


def ratio(num: Column | str, den: Column | str) -> Column:
    """Floating division; a zero or missing denominator gives null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def percent(num: Column | str, den: Column | str) -> Column:
    return ratio(F.lit(100.0) * _c(num).cast("double"), den)


# Two-decimal results round halves away from zero. They are rounded as whole
# hundredths: a tie is then exactly x.5, which a double can hold.


def round2(col: Column | str) -> Column:
    return F.round(_c(col), 2)


def ratio2(num: Column | str, den: Column | str) -> Column:
    return F.round(ratio(F.lit(100.0) * _c(num).cast("double"), den), 0) / F.lit(100.0)


def percent2(num: Column | str, den: Column | str) -> Column:
    return F.round(ratio(F.lit(10000.0) * _c(num).cast("double"), den), 0) / F.lit(100.0)


def usd_per(cents: Column | str, count: Column | str) -> Column:
    """Dollars per unit of ``count``."""
    return F.round(ratio(cents, count), 0) / F.lit(100.0)


def half_even(col: Column | str, digits: int = 0) -> Column:
    """Round halves to the even neighbour."""
    return F.bround(_c(col), digits)


def clip(col: Column | str, low: int, high: int) -> Column:
    return F.least(F.greatest(_c(col), F.lit(low)), F.lit(high))


def close_to(a: Column | str, b: Column | str, tolerance: float) -> Column:
    """Absolute tolerance test; a null on either side counts as different."""
    gap = F.abs(_c(a).cast("double") - _c(b).cast("double"))
    return F.coalesce(gap < F.lit(tolerance), F.lit(False))


# -- dates -------------------------------------------------------------------


def month_index(col: Column | str) -> Column:
    """Months since year 0; differences of it are month differences."""
    c = _c(col)
    return F.year(c) * 12 + F.month(c) - 1


def month_of_index(col: Column | str) -> Column:
    """Inverse of month_index: first day of that month."""
    c = _c(col)
    return F.make_date(F.floor(c / 12).cast("int"), (c % 12 + 1).cast("int"), F.lit(1))


DAYS_PER_YEAR = 365.25

# ISO order, Monday first.
WEEKDAYS = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]


# -- labels: fixed values, texts and limits -----------------------------------


def is_online_country(country: Column | str) -> Column:
    """The store master marks the web shop by the country 'Online'."""
    return F.coalesce(_c(country) == F.lit("Online"), F.lit(False))


def customer_type_label(orders: Column | str) -> Column:
    return F.when(_c(orders) == 1, F.lit("One-time (1 order)")).otherwise(
        F.lit("Repeat (2+ orders)")
    )


def year_completeness_label(year: Column | str, last_year: Column | str) -> Column:
    """The last year in the data is always taken as partial."""
    return F.when(_c(year) == _c(last_year), F.lit("PARTIAL YEAR")).otherwise(
        F.lit("FULL YEAR")
    )


def lifespan_label(orders: Column | str, days: Column | str) -> Column:
    n, d = _c(orders), _c(days)
    return (
        F.when(n == 1, F.lit("Single order (no lifespan)"))
        .when(d == 0, F.lit("Multiple orders, same day"))
        .when(d <= 30, F.lit("2+ orders within 30 days"))
        .when(d <= 180, F.lit("2+ orders, 31-180 days apart"))
        .when(d <= 365, F.lit("2+ orders, 181-365 days apart"))
        .otherwise(F.lit("2+ orders, over 1 year apart"))
    )


# -- presentation ------------------------------------------------------------


def display_number(col: Column | str, digits: int = 2) -> Column:
    """Thousands separators and fixed decimals, empty text for null."""
    return F.coalesce(F.format_number(_c(col), digits), F.lit(""))
