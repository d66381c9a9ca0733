"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8)
choose the data and the cores. Each query runs once to warm up and then
``BENCH_RUNS`` times (default 3) into the noop sink; the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINES = [
    "null_counts",
    "churn_labels",
    "labelled_log",
    "length_stats",
    "song_counts",
    "page_pivot",
    "hour_pivot_share",
    "most_active_hour",
    "device_by_label",
    "user_features",
    "user_features_fanout",
    "measure_quantiles_by_label",
    "price_by_date",
    "price_by_district_date",
    "clean_messages",
    "category_totals",
    "tokens_no_stop",
    "noun_lemmas",
    "tfidf_long",
    "report_from_labels",
    "split_users_exact",
]
ONCE = ["tune_svc", "message_report_lemmas"]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES + ONCE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if name in ONCE:
            seconds[name] = round(run(spark, name, sf_dir), 3)
            continue
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
