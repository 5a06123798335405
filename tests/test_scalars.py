import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.functions import scalars as S


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first().y


@pytest.mark.parametrize(
    "text, cents",
    [("$6.62 ", 662), ("$1,060.22 ", 106022), ("", None), ("nan", None), (None, None), ("7", 700)],
)
def test_parse_money(spark, text, cents):
    value = one(spark, text, S.parse_money("x"))
    assert (None if value is None else int(value * 100)) == cents


@pytest.mark.parametrize(
    "text, day",
    [
        ("1/1/2008", dt.date(2008, 1, 1)),
        ("1/12/2008", dt.date(2008, 1, 12)),
        ("12/31/2019", dt.date(2019, 12, 31)),
        ("13/45/2008", None),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_raw_date(spark, text, day):
    assert one(spark, text, S.parse_raw_date("x")) == day


@pytest.mark.parametrize("f, m, blend", [(1, 2, 2), (2, 3, 2), (3, 4, 4), (4, 5, 4), (5, 5, 5)])
def test_half_even_blend(spark, f, m, blend):
    assert one(spark, f, S.half_even((F.col("x") + m) / F.lit(2.0)), "int") == blend


def test_round2_goes_away_from_zero(spark):
    assert one(spark, 1.005, S.round2("x"), "double") == 1.01
    assert one(spark, -2.675, S.round2("x"), "double") == -2.68


def test_ratio_and_percent_guard_zero(spark):
    assert one(spark, 5, S.ratio("x", F.lit(0)), "int") is None
    assert one(spark, 5, S.percent("x", F.lit(20)), "int") == 25.0
    assert one(spark, None, S.percent("x", F.lit(20)), "int") is None


def test_close_to_counts_null_as_different(spark):
    assert one(spark, None, S.close_to("x", F.lit(1.0), 0.01), "double") is False
    assert one(spark, 1.001, S.close_to("x", F.lit(1.0), 0.01), "double") is True
    assert one(spark, 1.02, S.close_to("x", F.lit(1.0), 0.01), "double") is False


def test_online_country(spark):
    assert one(spark, "Online", S.is_online_country("x")) is True
    assert one(spark, "Italy", S.is_online_country("x")) is False
    assert one(spark, None, S.is_online_country("x")) is False


@pytest.mark.parametrize(
    "orders, days, label",
    [
        (1, 0, "Single order (no lifespan)"),
        (2, 0, "Multiple orders, same day"),
        (2, 1, "2+ orders within 30 days"),
        (2, 30, "2+ orders within 30 days"),
        (2, 31, "2+ orders, 31-180 days apart"),
        (2, 180, "2+ orders, 31-180 days apart"),
        (2, 181, "2+ orders, 181-365 days apart"),
        (2, 365, "2+ orders, 181-365 days apart"),
        (2, 366, "2+ orders, over 1 year apart"),
    ],
)
def test_lifespan_label(spark, orders, days, label):
    assert one(spark, days, S.lifespan_label(F.lit(orders), "x"), "int") == label


def test_month_index_round_trip(spark):
    day = dt.date(2020, 12, 17)
    back = S.month_of_index(S.month_index("x"))
    assert one(spark, day, back, "date") == dt.date(2020, 12, 1)


def test_display_number(spark):
    assert one(spark, 1234567.891, S.display_number("x"), "double") == "1,234,567.89"
    assert one(spark, None, S.display_number("x"), "double") == ""


def test_cents_are_exact(spark):
    from decimal import Decimal

    assert one(spark, Decimal("1060.22"), S.to_cents("x"), "decimal(10,2)") == 106022
    assert one(spark, 106022, S.usd("x"), "bigint") == 1060.22
