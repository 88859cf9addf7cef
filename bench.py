"""Times the headline queries; prints one line of JSON.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from risklake.plans import catalog  # noqa: E402
from risklake.session import ROCKSDB_PROVIDER, get_session  # noqa: E402

HEADLINE = [
    "dq_good", "mcc_risk_join", "velocity_features", "velocity_idle_reset", "behavioral_features",
    "geo_features", "device_features", "enriched_transactions", "score_all", "decisions",
    "collected_decisions", "fraud_by_country", "fraud_by_mcc", "fraud_by_hour", "velocity_summary",
    "daily_kpis", "velocity_windows", "point_in_time_join", "online_features", "upsert_current",
    "insert_new", "expand_features", "stream_velocity_windows", "stream_enricher",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    chosen = sys.argv[1:] or HEADLINE
    # One query first, so that starting Spark is not charged to the others.
    catalog.queries()["fraud_by_hour"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "rows": rows,
    }
    if "stream_enricher" in seconds:
        result["stream_enricher_rows_per_sec"] = round(rows / seconds["stream_enricher"])
    if "decisions" in seconds:
        result["decisions_rows_per_sec"] = round(rows / seconds["decisions"])
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
