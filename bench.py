"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is forced with the ``noop`` sink (full computation, nothing
collected). The model step times one histogram-boosting fit on the shared
model matrix (the reference quotes ~15 s for its single-node booster).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from churnlake.plans import catalog  # noqa: E402
from churnlake.session import local_session  # noqa: E402

HEADLINE = [
    "a1_accounts_scan",
    "b03_describe_numeric",
    "b06_missing_counts",
    "b09_duplicate_count",
    "b10_iqr_outliers",
    "b16_density_age_by_target",
    "b17_corr_matrix",
    "c05_impute_where_needed",
    "d01_engineered_features",
    "e02_stratified_kfold10",
    "f02_oof_te_last_name",
    "f07_oof_te_customer_id_multi",
    "f08_oof_te_conditional",
    "f09_te_conditional_apply_test",
    "g05_identity_match_audit",
    "i02_roc_auc",
    "i04_threshold_curve_161",
    "i05_threshold_top_pct",
    "i08_leaderboard",
]


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="churnlake-bench")
    catalog.queries()  # fills the catalog
    names = [n for n in HEADLINE if not only or re.search(only, n)]
    # Warm-up: JVM start, first scan and codegen are not part of any query.
    _force(catalog.run("b01_shape", spark, sf_dir))
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        _force(catalog.run(name, spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    if not only or re.search(only, "model_fit"):
        from churnlake.operators import models as H
        from churnlake.plans import churn

        t0 = time.perf_counter()
        train, test = churn.load(spark, sf_dir)
        m = churn.model_matrix(train, test, k=10)
        m.train.count()
        times["model_matrix"] = round(time.perf_counter() - t0, 3)
        t0 = time.perf_counter()
        est = H.boosted_hist(max_iter=int(os.environ.get("BENCH_GBT_ITERS", "100")), step=0.05,
                             max_leaf_nodes=31, min_leaf=20)
        model = H.fit_sized(est, m.train.where("fold != 0"))
        _force(H.score(model, m.train.where("fold = 0"), ["id", "exit_status"]))
        times["model_fit"] = round(time.perf_counter() - t0, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else None,
    }))


if __name__ == "__main__":
    main()
