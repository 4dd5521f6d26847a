"""Times the headline queries and prints one JSON line."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from threatlens.plans import catalog  # noqa: E402

HEADLINE = [
    "attack_patterns",
    "signature_alerts",
    "port_scan",
    "brute_force_alerts",
    "volume_anomaly_alerts",
    "top_malicious_ips",
    "volume_analysis",
    "threat_timeline",
    "normalize_raw_logs",
    "lake_roundtrip",
    "active_threats",
    "alert_summary_by_ip",
    "threat_profile",
    "profile_lookup",
    "stored_profile",
    "stream_brute_force",
    "stream_signature",
    "stream_volume",
]
#: Lookups are timed over tables that are stored before.
PREPARED = {"profile_lookup": catalog.prepared_lookup, "stored_profile": catalog.prepared_profile}
RUNS = 3


def run_once(spark: SparkSession, query: catalog.Query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threatlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = PREPARED[name](spark, sf_dir) if name in PREPARED else catalog.queries()[name]
        run_once(spark, query, sf_dir)
        seconds[name] = round(
            statistics.median(run_once(spark, query, sf_dir) for _ in range(RUNS)), 3
        )
    print(json.dumps({
        "metric": "headline queries, warm median of 3, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
