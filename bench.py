"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line at the end.

Each query's full plan is executed with the ``noop`` sink (no collect). The
derived booking table is built first and timed on its own (``fixture``); the
queries then scan it like a production booking table. Every figure is also
printed to stderr as soon as it exists. ``BENCH_ML=1`` (default) adds the model
queries, each at the reference's sizes and as the registered query runs it; they
come last, and none is begun after ``BENCH_SECONDS`` (default 1300), nor does one
hold up the result: when the time is over the line is printed with what there is
and the queries left out are named.
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fe_all_rowwise",
    "ref8_fit_apply_test",
    "fld1_temporal_folds",
    "fld2_fold_bounds",
    "eda1_rate_deposit_x_refundable",
    "eda2_rate_by_lead_x_deposit",
    "eda6_null_profile",
    "eda15_quarterly_rate",
    "met2_3_threshold_sweep",
    "met4_roc_auc_per_fold",
    "met8_metrics_per_fold",
    "met13_pooled_comparison",
    "met15_risk_deciles",
    "met18_pr_curve",
    "err3_perf_by_region",
    "err8_class_histogram",
    "sub2_submission",
    "sub3_contract_checks",
]
MODELS = ["ens5_6_ablation", "ens4_cv_cost_curve", "ens4_cv_pooled_comparison"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    limit = float(os.environ.get("BENCH_SECONDS", "1300"))
    names = HEADLINE + (MODELS if os.environ.get("BENCH_ML", "1") == "1" else [])
    from stayrisk.registry import QUERIES, load_all
    from stayrisk.session import local_session
    from stayrisk.sources import fixture

    began = time.time()
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="stayrisk-bench")
    load_all()
    times: dict[str, float] = {}

    def timed(name: str, job) -> None:
        t = time.time()
        job()
        times[name] = round(time.time() - t, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    def work() -> None:
        timed("fixture", lambda: fixture.reservations(spark, sf_dir).count())
        for name in names:
            if name in MODELS and time.time() - began > limit:
                break
            timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    worker = threading.Thread(target=work, daemon=True)
    worker.start()
    worker.join(limit)

    done = dict(times)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "total_query_seconds", "value": round(sum(done.values()), 3), "unit": "sec",
           "queries": done, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf_dir}
    if left := [n for n in names if n not in done]:
        out["not_finished"] = left
    print(json.dumps(out), flush=True)
    os._exit(0 if done else 1)  # an unfinished query does not keep the process


if __name__ == "__main__":
    main()
