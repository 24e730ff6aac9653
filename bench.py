"""Time the headline queries; prints one JSON line.

Every query runs whole into the ``noop`` sink: two warm-up runs, then the better of two
timed ones.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pulsegrid.catalog import load_all  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

HEADLINE = (
    "flt01_range_query",
    "ag01_bucket_stats",
    "ag02_bucket_counts",
    "ag03_label_signal_stats",
    "ag04_channel_stats",
    "ag05_window_summaries",
    "jn01_interval_join",
    "wn01_index_gaps",
    "val01_validate_signals",
    "ag11_assemble_windows",
    "ar02_robust_scale",
    "ar13_sequence_features",
    "ml01_score_and_flag",
    "ag16_subject_error_audit",
    "ag19_roc_auc",
    "ag25_latency_summary",
    "wn11_group_stratified_split",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        for _ in range(2):
            run(name)
        times[name] = round(min(run(name) for _ in range(2)), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
