"""Time the headline queries; prints one JSON line.

`$BENCH_SF_DIR` names the tables (default sf0.1), `$BENCH_CPUS` the local cores (default 8),
`$BENCH_RUNS` the timed runs after one warm-up (default 3); the median counts. Results are forced in
full with the noop writer.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparring.plans.queries import QUERIES  # noqa: E402
from sparring.session import local_session  # noqa: E402

RELATIONAL = (
    "split_regression",
    "split_stratified",
    "split_content_key",
    "leak_report",
    "leak_id_like",
    "class_spread",
    "target_correlation",
    "frequency_encode_brand",
    "standard_scale",
    "onehot_priority",
    "svd_gram",
    "soft_vote_mean",
    "classification_scores",
    "ranking_auc",
    "regression_scores",
    "prediction_wide",
)
# Fits are few and slow: one run each, without a warm-up of their own.
FITS = ("ols_one_feature", "logistic_regression_outputs", "random_forest_outputs", "mlp_outputs", "planted_classes")


def timed(query, spark, folder: str) -> float:
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in RELATIONAL:
        timed(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(timed(QUERIES[name], spark, folder) for _ in range(runs)), 3)
    for name in FITS:
        seconds[name] = round(timed(QUERIES[name], spark, folder), 3)
    print(json.dumps({
        "metric": "headline queries, median seconds summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
