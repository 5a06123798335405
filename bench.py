"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of source tables, BENCH_CPUS the local cores.
Each query is planned and run to completion once, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlens.registry import CUSTOMERS, SALES, catalogue  # noqa: E402
from basketlens.session import build_session  # noqa: E402

HEADLINE = [
    *[p.__name__ for p in [*SALES, *CUSTOMERS]],
    "clean_sales_enriched", "fact_sales_build", "revenue_local_currency",
    "dq_clean_suite", "dq_foreign_keys", "profile_tables",
    "rfm_segments", "rfm_segment_summary",
    "cohort_grid", "cohort_retention_pct", "cohort_month1_trend",
    "eda_order_revenue_stats", "eda_order_outliers", "eda_category_line_box",
    "eda_hist_order_revenue", "m_revenue_yoy", "m_average_order_value",
    "m_repeat_customers", "sliced_kpis", "drill_category",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "basketlens-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("kpi_summary")
    seconds = {name: round(run(name), 3) for name in (sys.argv[1:] or HEADLINE)}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
