"""Times the headline queries and prints one JSON line.

Every query is run from its inputs and forced by a ``noop`` write. Preparation
queries start at the raw tables; the analyses read the prepared tables that
``stage`` has written, whose cost is reported as ``stage_prepared``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadbay.catalog import queries as Q  # noqa: E402
from loadbay.session import build_session  # noqa: E402

HEADLINE = (
    "clean_products", "prepare_products", "prepare_workers", "sessionize",
    "anomalous_days", "anomalous_days_by_employee", "duration_outlier_rates",
    "top_duration_outliers", "describe_products", "describe_workers",
    "daily_products", "worker_productivity", "product_comparison", "kpi_overview",
    "trend_daily_count_split", "hour_heatmap", "process_by_product",
    "duration_histogram", "response_histogram_by_employee", "box_duration_by_product",
    "corr_products", "corr_workers", "filter_products", "name_map",
    "anonymize_products", "scrub_text",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        begin = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    spark.range(1000).groupBy().count().collect()
    times: dict[str, float] = {}
    begin = time.perf_counter()
    Q.P(spark, sf_dir)
    Q.W(spark, sf_dir)
    Q.maps(spark, sf_dir)
    times["stage_prepared"] = time.perf_counter() - begin
    chosen = sys.argv[1:] or HEADLINE
    for name in chosen:
        first = run(name)
        times[name] = min(first, run(name))
    times = {k: round(v, 3) for k, v in times.items()}
    print(json.dumps({"metric": "total seconds, headline queries", "unit": "sec",
                      "value": round(sum(times.values()), 3), "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
