"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query runs once to warm up and is then timed once, in full, without keeping its result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rowsmith.queries import QUERIES
from rowsmith.session import build_session

HEADLINE = [
    "clean_full", "quarantine_rows", "profile_missing", "score_validate",
    "split_stratified", "cv_folds", "sample_balanced",
    "fit_impute_mean", "fit_impute_median", "feat_full", "feat_train_test",
    "eval_confusion", "eval_report", "eval_auc_scores", "eval_auc_ovr", "eval_regression", "score_soft_vote",
    "reg_current", "reg_compare", "train_decision_tree", "score_batch", "stream_quarantine",
    "train_random_forest", "train_logistic", "train_linear_svc", "tune_grid", "score_ensemble", "stream_score",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus)
    first, second = {}, {}
    for name in names:
        first[name] = round(timed(spark, name, sf_dir), 3)
        second[name] = round(timed(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(second.values()), 3),
                "unit": "sec",
                "queries": second,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
