"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from burstguard.plans.queries import QUERIES  # noqa: E402
from burstguard.session import build_session  # noqa: E402

HEADLINE = [
    "all_alerts",
    "order_brush_alerts",
    "high_freq_alerts",
    "stuffing_alerts",
    "abnormal_login_alerts",
    "payment_fraud_alerts",
    "arrival_alerts",
    "stuffing_candidates",
    "payment_candidates",
    "rule_match",
    "rule_match_asof",
    "rule_snapshot",
    "behavior_normalized",
    "csv_multi_category",
    "alerts_per_minute",
    "feature_by_ip",
    "quality_by_rule",
    "latency_p99",
    "pattern_followed_by",
    "templates_matched",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("all_alerts")  # starts the executor threads and compiles the shared code
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "events": events,
                "all_alerts_events_per_sec": round(events / seconds["all_alerts"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
