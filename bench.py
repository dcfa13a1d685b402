"""Times the headline jobs and queries; prints one JSON line.

``publish`` is the load of all gold tables from the landing files. The queries
run after it, each once to its full result, over the tables it wrote.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.plans.publish import open_warehouse  # noqa: E402
from starloom.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "conform_dedup",
    "flagship",
    "sales_dashboard",
    "star_join",
    "far_star_join",
    "filtered_rollup",
    "calendar_rollup",
    "distinct_rollup",
    "m_total_revenue_ytd",
    "m_total_revenue_ly",
    "m_n_purchase_orders",
    "m_service_level_compliance",
    "m_on_time_delivery_rate",
    "m_asset_availability",
    "m_n_customers_created",
    "date_role_join",
    "drill_across",
    "snowflake_rollup",
    "bridge_rollup",
    "safe_left_join",
    "validation_summary",
    "clustered_rewrite",
]


def seconds(job: Callable[[], object]) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = open_warehouse(spark, folder)
    times = {"publish": seconds(warehouse.publish_all)}
    for name in HEADLINE:
        times[name] = seconds(
            lambda: QUERIES[name](warehouse).write.format("noop").mode("overwrite").save()
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name,
            }
        )
    )


if __name__ == "__main__":
    main()
