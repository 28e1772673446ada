"""Time the build steps and the headline queries; prints one JSON line.

Steps run in order in one session: each ``build_*`` entry writes that table once, the queries then
read the written tables, as a scheduled run would.
"""

from __future__ import annotations

import json
import os
import sys
import time

from recon360.plans.queries import QUERIES, as_result, open_run
from recon360.session import build_session, drop_scratch

BUILDS = {
    "build_staging_orders": lambda run: run.staging.orders,
    "build_staging_payments": lambda run: run.staging.payments,
    "build_customers": lambda run: run.customers,
    "build_id_crosswalk": lambda run: run.id_crosswalk,
    "build_clusters": lambda run: run.clusters,
    "build_dim_customer": lambda run: run.dim_customer,
    "build_dim_product": lambda run: run.dim_product,
    "build_fact_order": lambda run: run.fact_order,
    "build_fact_payment": lambda run: run.fact_payment,
    "build_order_payments": lambda run: run.order_payments,
    "build_fact_customer_issue": lambda run: run.fact_customer_issue,
    "build_dq_exceptions": lambda run: run.exceptions,
}
HEADLINE = [
    "bq1_revenue_by_month", "bq2_top_customers", "bq3_problem_orders", "bq4_revenue_by_state",
    "bq5_tickets_vs_exceptions", "dq_summary", "dq_detail", "parse_dates", "parse_money", "dedup_first",
    "dedup_most_complete", "duplicate_ids", "duplicate_pairs", "fk_resolve_orders", "order_amounts",
    "orders_with_payments", "dq004", "dq005", "dq007", "dq008", "dq010", "dq014", "scan_csv_text", "scan_jsonl_text",
    "dq_exceptions_export", "check_row_accounting", "check_referential", "check_amounts", "check_parsing", "check_key_unique",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = open_run(spark, sf_dir)
    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr)

    for name, build in BUILDS.items():
        timed(name, lambda: build(run))
    for name in HEADLINE:
        timed(name, lambda: as_result(QUERIES[name](run)).write.format("noop").mode("overwrite").save())
    drop_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "build_and_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
