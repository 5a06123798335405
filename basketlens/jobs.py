"""Batch jobs: export files to star, star to published tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from basketlens.plans import cohorts, rfm
from basketlens.plans.cleaning import build_star
from basketlens.plans.quality import (
    PRIMARY_KEYS,
    clean_suite,
    primary_keys,
    require_passed,
    star_suite,
    suite_numbers,
    union_checks,
    unreadable_cells,
)
from basketlens.sources.raw_files import read_raw_cells, read_raw_folder, write_table
from basketlens.sources.staging import stage
from basketlens.sources.star import Star, read_star, write_star


def build_warehouse(spark: SparkSession, raw_folder: str, out_folder: str) -> Star:
    """Read the export, clean it, store the star and open the stored tables.

    Nothing is stored if a cell can't be read as its type, or if a dimension
    has a null key or one key twice, which would multiply sales lines.
    """
    star = build_star(read_raw_folder(spark, raw_folder))
    # The calendar is made, not read, and has its days once.
    dimensions = [t for t in PRIMARY_KEYS if t != "dim_date"]
    require_passed(
        union_checks(
            [unreadable_cells(read_raw_cells(spark, raw_folder)), primary_keys(star, dimensions)]
        )
    )
    write_star(star, out_folder)
    return read_star(spark, out_folder)


def validate_warehouse(spark: SparkSession, raw_folder: str, star: Star) -> DataFrame:
    """Run both check suites once; raise if a check fails, else return the results."""
    raw = read_raw_folder(spark, raw_folder)
    numbers = suite_numbers(star)
    checks = clean_suite(star, numbers).unionByName(star_suite(star, raw, numbers=numbers))
    results = spark.createDataFrame(checks.collect(), checks.schema)  # 34 rows
    require_passed(results)
    return results


def publish_segments(star: Star, out_folder: str, fmt: str = "parquet") -> None:
    """The customer table with scores and segment, and its summary."""
    root = out_folder.rstrip("/")
    segments = stage(rfm.rfm_segments(star), "rfm-segments")
    write_table(segments, f"{root}/customer_rfm", fmt)
    write_table(rfm.segment_summary(segments), f"{root}/segment_summary", fmt)


def publish_cohorts(star: Star, out_folder: str, fmt: str = "parquet") -> None:
    """Cohort counts and percentages as wide tables."""
    root = out_folder.rstrip("/")
    # Both matrices read the written grid, so the orders are read once.
    grid = stage(cohorts.cohort_grid(cohorts.cohort_active(star)), "cohort-grid")
    write_table(cohorts.cohort_matrix(grid), f"{root}/cohort_counts", fmt)
    write_table(cohorts.cohort_pct_matrix(grid), f"{root}/cohort_percent", fmt)


def publish_reports(
    star: Star,
    reports: Iterable[Callable[[Star], DataFrame]],
    out_folder: str,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Store each report; a failing one is noted and the run goes on."""
    failures = {}
    for report in reports:
        try:
            write_table(report(star), f"{out_folder.rstrip('/')}/{report.__name__}", fmt)
        except Exception as error:  # noqa: BLE001 - reported to the caller
            failures[report.__name__] = str(error).splitlines()[0]
    return failures
