"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads.
Each query runs once to warm up and is then timed, with all its rows consumed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lanewatch.session import build_session  # noqa: E402
from workload.queries import queries  # noqa: E402

HEADLINE = (
    "filter_conjunction", "sort_multi", "count_rows",
    "group_profile", "group_profile_single_pass", "group_median_approx",
    "group_profile_many_groups", "numeric_validation",
    "packet_decode", "packet_filter_sort", "packet_profile", "packet_capture_scan",
    "fcd_xml_ingest", "emission_xml_ingest", "json_decode_route",
    "radius_join", "radius_join_grid",
    "traffic_tumbling", "traffic_sliding", "traffic_approx",
    "pollution_tumbling", "pollution_sliding", "pollution_null_as_zero",
    "stream_traffic", "stream_pollution", "stream_union",
    "result_messages", "features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries, second run",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
