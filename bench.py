"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.catalog.all import REGISTRY  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

HEADLINES = [
    "clean_rows", "baseline_profile", "cleanup_funnel", "token_frequency", "vocabulary", "encoded_long_texts",
    "train_val_test_split", "feature_rows", "nb_token_counts", "predicted_labels", "test_confusion", "drift_report",
    "feedback_status", "combined_corpus", "statement_debits", "spend_percentages", "latency_histogram_per_hour",
    "latency_quantiles_sliding", "rolling_error_rate_by_endpoint", "increase_per_hour", "alert_transitions",
    "early_stop", "stream_request_counters", "encoded_texts", "description_lines", "predicted_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = build_session("bench", f"local[{cpus}]", int(cpus), shared, spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().collect()
    names = [n for n in (sys.argv[1:] or HEADLINES) if n in REGISTRY]
    times = {}
    for name in names:
        began = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
