"""Time the headline queries; prints one JSON line.

Each query runs to completion into a no-op sink, from the given tables on: none reads what another
one wrote. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and threads.
"""

from __future__ import annotations

import json
import os
import time

from gridmetrics.session import local_session
from workload.queries import QUERIES

HEADLINE = [
    "fact_demand",
    "fact_generation",
    "mv_renewables_share_parsed",
    "parse_demand",
    "parse_generation",
    "parse_generation_lines",
    "quarantine_generation",
    "parse_prices",
    "modal_grain",
    "dedupe_natural_key",
    "upsert_merge",
    "watermark_upsert",
    "dim_date",
    "fact_price",
    "mv_renewables_share",
    "mv_avg_price",
    "gold_row_counts",
    "star_join_month",
    "dq_results",
    "dq_invariants",
    "demand_by_month_complete",
    "demand_yoy_r12",
    "generation_by_month_technology_complete",
    "share_by_month",
    "price_daily_avg30d",
    "latest_per_series",
    "top10_prices",
    "rolling7_daily_mean",
    "plan_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
