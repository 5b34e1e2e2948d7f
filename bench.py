"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the local cores.
Each query runs whole and writes to a sink that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans.catalogue import QUERIES  # noqa: E402
from starloom.session import get_session  # noqa: E402

# pipeline_end_to_end builds everything anew; the queries after it read the
# session's stored star, as reports do, except for the rules on raw orders.
HEADLINE = (
    "pipeline_end_to_end",
    "dedup_orders_last",
    "clean_orders_all",
    "rule_audit",
    "clean_clients_all",
    "client_segments",
    "surrogate_keys",
    "dim_client",
    "fait_ventes",
    "mv_monthly_revenue",
    "mv_top_products",
    "mv_return_rate",
    "mv_courier_performance",
    "q1_monthly_revenue_yoy",
    "q2_top10_products_city",
    "q3_basket_by_segment",
    "q4_return_rate",
    "q5_period_effect",
    "orphan_keys",
    "kpi_summary",
    "dq_report",
    "fact_upsert",
    "scd2_merge",
)


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "starloom-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run_once(spark, "q1_monthly_revenue_yoy", folder)  # starts the JVM code paths and stores the star
    seconds = {name: round(run_once(spark, name, folder), 3) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
