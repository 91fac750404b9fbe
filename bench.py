"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated) other
queries than the default ones. Each query runs once to warm up and then three times; the median
counts. Results are written to a sink that drops them, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbline.checks import registry  # noqa: E402
from kerbline.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_events", "silver_base", "dedup_events", "balanced_sample", "time_split",
    "silver_history", "rolling_occ", "silver_priors", "label_next_window", "train_ready_day",
    "impute_duration", "lump_rare", "winsorize", "robust_z", "occ_by_hour", "street_hour_pivot",
    "day_hour_heatmap", "street_anomalies", "describe_duration", "dwell_by_violation",
    "daily_trend", "roc_curve", "auc", "window_occupancy", "occupancy_change",
]
RUNS = 3


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kerbline-bench-"))
    queries = registry.queries()
    seconds = {}
    for name in names:
        run(queries[name], spark, folder)
        seconds[name] = round(
            statistics.median(run(queries[name], spark, folder) for _ in range(RUNS)), 3
        )
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
