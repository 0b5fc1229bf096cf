"""Benchmark: run the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

The benefit-scheme tables are first derived from the driver parquet and
written once to a warehouse folder under the session's checkpoint folder
(timed as ``load_tables``); every job then runs against the stored tables, as
in a deployment.  Each job: one warm-up, then the median of BENCH_RUNS timed
runs into the ``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from schemelens.registry import load_all  # noqa: E402
from schemelens.session import build_session, checkpoint_dir  # noqa: E402
from schemelens.sources.catalog import Catalog  # noqa: E402

HEADLINE = [
    # join reports
    "v01_application_flow", "q03_application_detail", "q30_end_to_end_report",
    # aggregate reports
    "q08_status_counts", "q15_funds_per_scheme", "q17_rural_urban", "q19_category_benefits",
    "q24_officer_dashboard", "r01_scheme_report",
    # anti-join / correlated
    "q09_unapplied_eligible", "q22_below_state_avg_unapplied", "b01_payment_run",
    # rules
    "f01_check_eligibility", "f01c_ineligibility_reason_counts",
    # constraint jobs
    "d01_not_null", "d02_unique_keys", "d03_foreign_keys", "d05_range_checks", "d08_pool_ledger_reconciliation",
    # batch workflows
    "p03_apply_batch", "a02_budget_prefix", "a01_budget_allocation", "p04_decide_batch",
    # change-driven jobs
    "t01_audit_trail", "t02b_running_balance", "t03_duplicate_guard", "s01_audit_trail_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="schemelens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    jobs = load_all()
    timings: dict[str, float] = {}

    # untimed warm-up: JIT / class loading of the first jobs of a fresh JVM
    spark.range(0, 1_000_000, numPartitions=int(cpus)).selectExpr("id % 97 as k").groupBy("k").count().collect()

    t0 = time.time()
    derived = Catalog.from_testdata(spark, sf_dir)
    warehouse = os.path.join(checkpoint_dir(spark), f"warehouse-{uuid.uuid4().hex[:10]}")
    # bucketed storage is opt-in: it removes the citizen_id shuffles, but a hot
    # citizen would fill one bucket and AQE cannot split a bucket it never shuffles
    buckets = int(os.environ.get("BENCH_BUCKETS", "0"))
    cat = derived.materialize(warehouse, buckets=buckets or None)
    timings["load_tables"] = round(time.time() - t0, 3)

    for name in (only or HEADLINE):
        fn = jobs[name].fn
        fn(cat).write.format("noop").mode("overwrite").save()  # warm-up
        ts = []
        for _ in range(runs):
            t = time.time()
            fn(cat).write.format("noop").mode("overwrite").save()
            ts.append(time.time() - t)
        timings[name] = round(statistics.median(ts), 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_job_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
