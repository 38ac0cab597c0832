"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
The result is written to Spark's no-op sink, so every row and column is produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.registry import QUERIES  # noqa: E402
from wattline.session import build_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "five_minute_rollup",
    "latest_events",
    "event_counts",
    "freshness",
    "live_demand",
    "generation_balance",
    "demand_hourly",
    "intensity_series",
    "intensity_demand_overlay",
    "low_carbon_windows",
    "alert_demand_spike",
    "alert_high_intensity",
    "alert_silence",
    "tile_recent_rollup",
    "demand_outliers",
    "threshold_alerts",
    "rising_edge_alerts",
    "eia_demand_payload",
    "weather_payload",
    "event_json_round_trip",
    "contract_eia_demand",
    "silver_demand",
    "silver_generation",
    "silver_carbon",
    "silver_upsert_two_loads",
    "fact_demand",
    "fact_generation",
    "fact_carbon_intensity",
    "incremental_fact",
    "raw_quality_findings",
    "duplicate_line_keys",
    "fuel_share",
    "peak_load_fuels",
    "daily_profile",
    "low_carbon_runs",
    "customer_history",
    "quality_report",
    "silver_merge_two_loads",
    "stream_rollup",
    "stream_edge_alerts",
    "stream_fan_out",
    "stream_rejected_events",
    "medallion_counts",
    "demand_forecast",
)


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        taken = [run(spark, name, sf_dir) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(taken), 4)
    line = {
        "metric": "total warm time of the headline queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
