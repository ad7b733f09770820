"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed in full with the no-op sink (no transfer to the driver).
"""
from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "person_features",
    "rule_segment_distribution",
    "fct_segments_with_ml",
    "mart_wide",
    "model_vs_rule",
    "dq_reconcile",
    "dq_relationships",
    "dq_unique",
    "assign_fixed_centroids",
    "silhouette_fixed",
    "train_score_gold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("SEGMARK_TMP", tempfile.mkdtemp(prefix="segmark-bench-"))
    from segmark.plans.catalog import QUERIES
    from segmark.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="segmark-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    # Warm-up outside the timings: JVM start, class loading, code generation and JIT,
    # run on a smaller scale factor than the measured one (other files, same plans).
    base = os.path.dirname(sf_dir.rstrip("/"))
    smaller = [d for d in ("sf0.01", "sf0.001") if os.path.isdir(os.path.join(base, d))
               and os.path.join(base, d) != sf_dir.rstrip("/")]
    warm_dir = os.path.join(base, smaller[0]) if smaller else sf_dir
    for name in ("person_features", "mart_wide", "dq_reconcile", "silhouette_fixed", "train_score_gold"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    # First touch of the measured files (listing, footers, page cache) with a query that
    # is not timed, so the first timed query is measured warm like the others.
    QUERIES["stage_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).count()
    persons = QUERIES["person_features"](spark, sf_dir).count()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "orders": orders,
        "persons": persons,
        "sec_per_million_persons": {k: round(v / persons * 1e6, 2) for k, v in times.items()} if persons else {},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
