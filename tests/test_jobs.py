import pytest

from basketlens import jobs
from basketlens.plans import rfm, sales
from basketlens.plans.cleaning import build_star
from basketlens.plans.quality import QualityError
from basketlens.session import apply_recommended
from basketlens.sources.raw_files import RAW_FILES, RAW_SCHEMAS, read_raw_folder
from basketlens.sources.staging import Workspace, shared_folder, stage
from basketlens.sources.star import TABLES, Star, read_published_csv, read_star, write_star
from basketlens.sources.versions import Versions
from shop import CUSTOMERS, PRODUCTS, RATES, STORES, raw_shop, sale

SALES = [
    sale(o, 1, f"{1 + o % 9}/{1 + o % 28}/{2018 + o % 2}", 1 + o % 5, product=1 + o % 3,
         quantity=1 + o % 7)
    for o in range(1, 40)
]


def export(spark, folder, products=PRODUCTS, customers=CUSTOMERS):
    raw = raw_shop(spark, SALES, products, customers, STORES, RATES)
    raw["data_dictionary"] = spark.createDataFrame(
        [("Sales", "Quantity", "Units")], RAW_SCHEMAS["data_dictionary"]
    )
    for name, file in RAW_FILES.items():
        raw[name].coalesce(1).write.option("header", True).csv(f"{folder}/{file}")


def test_export_to_published_tables(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "star")
    export(spark, raw)
    star = jobs.build_warehouse(spark, raw, out)
    checks = jobs.validate_warehouse(spark, raw, star)
    assert checks.count() == 34
    jobs.publish_cohorts(star, out)
    assert spark.read.parquet(f"{out}/cohort_percent").columns[:2] == ["cohort_month", "period_0"]

    def broken(star):
        return star.lines("no_such_column")

    failures = jobs.publish_reports(star, [sales.kpi_summary, broken, sales.category_revenue], out)
    assert list(failures) == ["broken"]
    assert spark.read.parquet(f"{out}/kpi_summary").first().total_orders == 39
    assert spark.read.parquet(f"{out}/category_revenue").count() == 2


RELABELLED = (9, "Lamp 2", "Acme", "Red", "$4.00 ", "$10.00 ", "11", "Lights", "1", "Home")


@pytest.mark.parametrize("changed,key", [
    ({"products": [*PRODUCTS, PRODUCTS[0]]}, "dim_product.product_key"),
    ({"products": [*PRODUCTS, RELABELLED]}, "dim_subcategory.subcategory_key"),
    ({"customers": [*CUSTOMERS, CUSTOMERS[0]]}, "dim_customer.customer_key"),
    ({"customers": [*CUSTOMERS, (None, *CUSTOMERS[0][1:])]}, "dim_customer.customer_key"),
])
def test_bad_dimension_keys_stop_the_build(spark, tmp_path, changed, key):
    export(spark, str(tmp_path / "raw"), **changed)
    with pytest.raises(QualityError, match=key):
        jobs.build_warehouse(spark, str(tmp_path / "raw"), str(tmp_path / "star"))
    assert not (tmp_path / "star").exists()


def test_segments_are_published(spark, star, tmp_path):
    jobs.publish_segments(star, str(tmp_path))
    table = spark.read.parquet(f"{tmp_path}/customer_rfm")
    summary = spark.read.parquet(f"{tmp_path}/segment_summary")
    assert summary.groupBy().sum("num_customers").first()[0] == table.count()


def test_staging_writes_where_the_session_says(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == root
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert f"{root}/basketlens/numbers-" in staged.inputFiles()[0]


def test_workspace_tables_are_dropped(spark):
    space = Workspace(spark, "space")
    saved = space.save(spark.range(3), "a")
    assert saved.count() == 3
    space.drop("a")
    space.save(spark.range(4), "a")
    assert spark.read.parquet(space.path("a")).count() == 4


def test_recommended_settings_respect_the_session(spark):
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    spark.conf.set(key, "false")
    try:
        apply_recommended(spark)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, "true")


def test_published_csv_tables_open_again_with_their_types(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "csv")
    export(spark, raw)
    star = build_star(read_raw_folder(spark, raw))
    write_star(star, out, "csv")
    back = read_star(spark, out, "csv")
    for name in TABLES:
        ours, theirs = star.table(name), back.table(name)
        assert dict(theirs.dtypes) == {c: t for c, t in ours.dtypes if c in theirs.columns}, name
        assert sorted(map(str, theirs.select(*theirs.columns).collect())) == sorted(
            map(str, ours.select(*theirs.columns).collect())
        )
    assert sales.kpi_summary(back).collect() == sales.kpi_summary(star).collect()


def test_published_segments_open_again_with_their_types(spark, star, tmp_path):
    jobs.publish_segments(star, str(tmp_path), "csv")
    segments = rfm.rfm_segments(star)
    back = read_published_csv(spark, str(tmp_path), "customer_rfm")
    assert back.dtypes == segments.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, segments.collect()))


def stored(spark, folder):
    return {n: sorted(map(str, read_star(spark, folder).table(n).collect())) for n in TABLES}


def test_a_load_that_fails_leaves_the_old_star_whole(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "star")
    export(spark, raw)
    star = build_star(read_raw_folder(spark, raw))
    write_star(star, out)
    before = stored(spark, out)
    versions = Versions(spark, out).published()
    for fifth in ("dim_store", "fact_sales"):
        broken = {n: star.table(n) for n in TABLES}
        broken = {n: t.limit(1) if n.startswith("dim") else t for n, t in broken.items()}
        broken[fifth] = star.table(fifth).selectExpr("*", "CAST(raise_error('torn') AS INT) AS x")
        with pytest.raises(Exception, match="torn"):
            write_star(Star(broken), out)
        assert stored(spark, out) == before
        assert Versions(spark, out).published() == versions
        assert [p.name for p in (tmp_path / "star" / "versions").iterdir()] == versions


def test_a_star_is_rewritten_from_itself_and_old_versions_go(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "star")
    export(spark, raw)
    write_star(build_star(read_raw_folder(spark, raw)), out)
    before, opened = stored(spark, out), read_star(spark, out)
    for _ in range(2):
        tables = {n: read_star(spark, out).table(n) for n in TABLES}
        tables["fact_sales"] = tables["fact_sales"].drop("order_year")
        write_star(Star(tables), out)
        assert stored(spark, out) == before
        if _ == 0:
            # Whoever opened the version before still reads it.
            assert opened.table("fact_sales").count() == len(before["fact_sales"])
    versions = Versions(spark, out).published()
    assert len(versions) == 2 and sorted(versions, reverse=True) == versions
    assert sorted(p.name for p in (tmp_path / "star" / "versions").iterdir()) == sorted(versions)


def test_tables_written_without_versions_open_too(spark, tmp_path):
    raw = str(tmp_path / "raw")
    export(spark, raw)
    star = build_star(read_raw_folder(spark, raw))
    for name in TABLES:
        star.table(name).write.parquet(f"{tmp_path}/plain/{name}")
    assert read_star(spark, f"{tmp_path}/plain").table("fact_sales").count() == 39
