"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores; ``BENCH_KEYS``
picks other queries. Every query is run to its last row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from flowloom.plans.queries import QUERIES
from flowloom.session import build_session

HEADLINE = [
    "project_connection", "delta_earliest_file", "semi_complete_days", "ledger_semi_webrequest", "select_by_ledger",
    "ip_range_join", "lookup_user", "lookup_asset", "join_urls", "infer_direction", "agg_server_day", "agg_device_day",
    "flow_detail", "flow_total", "cube_device", "cube_server", "pivot_metrics", "derive_disk", "profile_disk", "profile_cpu",
    "filter_site_category", "filter_ports", "filter_application_list", "traffic_matrix_edges", "topn_sites", "shrink_matrix",
    "dedupe_best_row", "parse_listener_log", "pseudonymize", "job_sitemap",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",")
    spark = build_session("flowloom-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    # One small query starts the executor threads and the reader before the clock does.
    QUERIES["classify_engine"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for key in keys:
        start = time.perf_counter()
        QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
