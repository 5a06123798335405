import datetime as dt
from collections import Counter

import pytest

from basketlens.plans import cleaning
from basketlens.registry import money_as_double
from basketlens.sources import raw_files, raw_text
from basketlens.sources.star import TABLES, read_star, register_views, write_star
from shop import raw_shop, rows, sale, shop_star

SALES = [
    sale(1, 1, "1/1/2019", 1, product=2, quantity=2, delivery="1/5/2019"),
    sale(1, 2, "1/1/2019", 1, product=1, quantity=3),
    sale(2, 1, "2/1/2019", 2, product=3, store=0),
    sale(3, 1, "13/45/2019", 3, product=77, delivery="never"),
]


def test_clean_sales(spark):
    raw = raw_shop(spark, SALES)
    clean = cleaning.clean_sales(raw["sales"], cleaning.clean_products(raw["products"]))
    got = rows(money_as_double(clean), "order_number", "line_item")
    assert len(got) == len(SALES)
    desk, lamp, phone, unknown = got
    assert desk["revenue_usd"] == 2120.44 and desk["cost_usd"] == 1200.2
    assert desk["profit_usd"] == 920.24 and desk["is_delivered"]
    assert desk["order_date"] == dt.date(2019, 1, 1)
    assert lamp["revenue_usd"] == 30.0 and not lamp["is_delivered"]
    assert phone["delivery_date"] is None
    # Unreadable dates and unknown products become null; the row stays.
    assert unknown["order_date"] is None and unknown["delivery_date"] is None
    assert unknown["revenue_usd"] is None and not unknown["is_delivered"]


def test_star_tables(spark):
    star = shop_star(spark, SALES)
    days = star.table("dim_date").orderBy("date_key").collect()
    assert (days[0].date_key, days[-1].date_key) == (dt.date(2019, 1, 1), dt.date(2019, 2, 1))
    assert len(days) == 32
    tuesday = days[0]
    assert (tuesday.day_of_week, tuesday.day_name, tuesday.is_weekend) == (1, "Tuesday", False)
    assert days[4].is_weekend and days[5].is_weekend and not days[6].is_weekend
    assert star.table("dim_category").count() == 2
    assert star.table("dim_subcategory").count() == 4
    stores = {r.store_key: r for r in star.table("dim_store").collect()}
    assert stores[0].is_online and stores[0].square_meters is None
    assert not stores[1].is_online and stores[1].open_date == dt.date(2008, 1, 12)
    third = star.table("dim_customer").where("customer_key = 3").first()
    assert third.zip_code == "01234" and third.state_code is None


def test_local_currency(spark):
    star = shop_star(spark, SALES[:3])
    got = rows(cleaning.revenue_local_currency(star), "currency_code")
    assert got[0]["revenue_usd"] == 2250.44
    assert got[0]["revenue_local"] == pytest.approx(0.9 * 2150.44 + 0.8 * 100, abs=0.005)
    assert got[0]["lines_without_rate"] == 0
    late = shop_star(spark, [*SALES[:3], sale(4, 1, "3/1/2019", 1)])
    assert rows(cleaning.revenue_local_currency(late), "currency_code")[0]["lines_without_rate"] == 1


def test_raw_text_cleans_back_to_the_mapped_star(spark, star):
    """Formatting to text and parsing again is the identity."""
    rebuilt = cleaning.build_star(dict(raw_text.RawTables(star)))
    for name in TABLES:
        a = Counter(map(tuple, star.table(name).collect()))
        b = Counter(map(tuple, rebuilt.table(name).select(*star.table(name).columns).collect()))
        assert a == b, name


def test_generic_views_equal_mapped_views(spark, star):
    rebuilt = cleaning.build_star(dict(raw_text.RawTables(star)))
    views = [
        lambda s: s.lines("category_name", "channel", "customer_country", "year", "revenue_cents"),
        lambda s: s.orders("order_number", "customer_key", "order_date", "revenue_cents", "n_lines"),
        lambda s: s.product_totals("revenue_cents", "profit_cents", "quantity"),
        lambda s: s.customers("orders", "revenue_cents", "first_date", "last_date"),
        lambda s: s.revenue_total(),
        lambda s: s.last_order_date(),
    ]
    for view in views:
        assert Counter(view(star).collect()) == Counter(view(rebuilt).collect())


def test_write_and_read_star(spark, tmp_path):
    star = shop_star(spark, SALES[:3])
    write_star(star, str(tmp_path))
    again = read_star(spark, str(tmp_path))
    for name in TABLES:
        columns = star.table(name).columns
        a = Counter(star.table(name).collect())
        assert a == Counter(again.table(name).select(*columns).collect()), name
    one_year = again.lines("year", "revenue_cents").where("year = 2019")
    assert one_year.groupBy().sum("revenue_cents").first()[0] == 225044
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    by_year = Counter(again.orders("year", "revenue_cents").collect())
    assert by_year == Counter(star.orders("year", "revenue_cents").collect())
    register_views(again)
    assert spark.sql("SELECT count(*) AS n FROM fact_sales").first().n == 3


def test_unknown_column_is_refused(star):
    with pytest.raises(ValueError):
        star.lines("shoe_size")


def test_csv_folder(spark, tmp_path):
    def write(name, text, encoding="utf-8"):
        (tmp_path / name).write_bytes(text.encode(encoding))

    write("Sales.csv", "Order Number,Line Item,Order Date,Delivery Date,CustomerKey,StoreKey,"
          "ProductKey,Quantity,Currency Code\n1,1,1/1/2019,,1,0,1,2,EUR\n")
    # 0x80-0x9F differ between Latin-1 and Windows-1252.
    write("Customers.csv", "CustomerKey,Gender,Name,City,State Code,State,Zip Code,Country,"
          "Continent,Birthday\n1,Female,Zoë Škoda €,Köln,,NRW,00123,Germany,"
          "Europe,2/3/1980\n", "cp1252")
    write("Products.csv", "ProductKey,Product Name,Brand,Color,Unit Cost USD,Unit Price USD,"
          "SubcategoryKey,Subcategory,CategoryKey,Category\n"
          '1,"Lamp, tall",Acme,Red,"$6.62 ","$1,060.22 ",0101,Lamps,01,Home\n')
    write("Stores.csv", "StoreKey,Country,State,Square Meters,Open Date\n0,Online,Online,,1/1/2010\n")
    write("Exchange_Rates.csv", "Date,Currency,Exchange\n1/1/2019,EUR,0.9\n")
    write("Data_Dictionary.csv", "Table,Field,Description\nSales,Quantity,Units\n")
    raw = raw_files.read_raw_folder(spark, str(tmp_path))
    star = cleaning.build_star(raw)
    customer = star.table("dim_customer").first()
    assert customer.name == "Zoë Škoda €" and customer.city == "Köln"
    assert customer.zip_code == "00123"
    product = star.product_flat("product_name", "category_key", "category_name").first()
    assert product.product_name == "Lamp, tall" and product.category_key == "01"
    assert star.revenue_total().first().total_cents == 212044
    assert raw["data_dictionary"].first().Field == "Quantity"


def test_windows_1252_pairs_cover_the_defined_characters():
    seen, meant = raw_files._windows_1252_pairs()
    assert len(seen) == len(meant) == 27


def test_typed_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2020, 2, 29))], "id bigint, day date")
    raw_files.write_table(df, str(tmp_path / "t"), "csv")
    back = raw_files.read_csv(spark, str(tmp_path / "t"), df.schema, date_format="yyyy-MM-dd")
    assert back.collect() == df.collect()


NAMES = ["Key", "Label", "Brand", "Price"]
TYPES = raw_files._schema("Key:long, Label:text, Brand:text, Price:double")


def csv_of(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_and_null_words(spark, tmp_path):
    path = csv_of(tmp_path, 'Key,Label,Brand,Price\n1,"TV 52"" LCD, Black",NA,1.5\n2,x,"n/a ",NA\n')
    got = [tuple(r) for r in raw_files.read_csv(spark, path, TYPES).collect()]
    assert got == [(1, 'TV 52" LCD, Black', None, 1.5), (2, "x", "n/a ", None)]
    assert raw_files.unreadable(raw_files.read_cells(spark, path, NAMES), TYPES).first().n == 0


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = csv_of(tmp_path, 'Key,Label,Brand,Price\n1,"two\nlines",b,1\n2,x,y,2\n')
    got = raw_files.read_csv(spark, path, TYPES, line_breaks=True).collect()
    assert [r.Label for r in got] == ["two\nlines", "x"]


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    path = csv_of(tmp_path, "Label,Key,Brand,Price\nx,1,b,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw_files.read_csv(spark, path, TYPES).collect()


def test_csv_counts_what_it_cannot_read(spark, tmp_path):
    path = csv_of(tmp_path, "Key,Label,Brand,Price\nx12,a,b,1\n2,a,b,cheap\n3,a,b\n4,a,b,2.5\n")
    cells = raw_files.read_cells(spark, path, NAMES)
    assert raw_files.unreadable(cells, TYPES).first().n == 3
    assert [r.Key for r in raw_files.typed_cells(cells, TYPES).collect()] == [None, 2, 3, 4]


def test_csv_round_trip_keeps_quotes_and_commas(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', "d", 2.0)], TYPES)
    raw_files.write_table(df, str(tmp_path / "t"), "csv")
    assert raw_files.read_csv(spark, str(tmp_path / "t"), TYPES).collect() == df.collect()
