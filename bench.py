"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local
threads, BENCH_QUERIES (comma separated) a choice of queries. Each query runs
once to warm up and then three times; the median counts. All rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortwise.plans.queries import QUERIES  # noqa: E402
from cohortwise.session import build_session  # noqa: E402

HEADLINE = [
    "explore_flow",
    "class_zero_one",
    "multilabel_binarize",
    "target_counts",
    "target_breakdown",
    "label_encode",
    "join_scans",
    "split_by_list",
    "cohort_by_list",
    "seeded_order_by_class",
    "stratified_split",
    "stratified_split3",
    "bootstrap_per_class",
    "resample_to_value",
    "undersample",
    "prepare_splits",
    "prepare_job",
    "classification_report_lines",
    "roc_auc_lines",
    "run_summary",
    "early_stop",
    "best_epochs",
    "frechet_distance",
    "inception_score",
    "stream_confusion",
]
RUNS = 3


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run(spark, name, sf_dir)
        timings[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(RUNS)), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
