"""Scale probe (not a registered query): derive an N-times copy of the tables the
adapter reads (key-offset replicas of the given data) and time headline queries on it.
With --hot, one person receives a third of all orders (skew check).

    python scripts/scale_probe.py /root/testdata/sf0.1 10 [--hot]
"""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def replicate(spark, src: str, dst: str, copies: int, hot: bool) -> None:
    orders = spark.read.parquet(f"{src}/orders.parquet")
    lineitem = spark.read.parquet(f"{src}/lineitem.parquet")
    supplier = spark.read.parquet(f"{src}/supplier.parquet")
    ok = orders.agg(F.max("o_orderkey")).first()[0] + 1
    ck = orders.agg(F.max("o_custkey")).first()[0] + 1
    sk = supplier.agg(F.max("s_suppkey")).first()[0] + 1
    rep = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("rep")
    o = orders.select("*", rep).select(
        (F.col("o_orderkey") + F.col("rep") * ok).alias("o_orderkey"),
        (F.col("o_custkey") + F.col("rep") * ck).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    if hot:
        o = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")))
    li = lineitem.select("*", rep).select(
        (F.col("l_orderkey") + F.col("rep") * ok).alias("l_orderkey"),
        "l_partkey",
        (F.col("l_suppkey") + F.col("rep") * sk).alias("l_suppkey"),
        *[c for c in lineitem.columns if c not in ("l_orderkey", "l_partkey", "l_suppkey")],
    )
    s = supplier.select("*", rep).select(
        (F.col("s_suppkey") + F.col("rep") * sk).alias("s_suppkey"), "s_name", "s_nationkey", "s_acctbal"
    )
    for name, df in (("orders", o), ("lineitem", li), ("supplier", s)):
        # Many files, as a large table would have (one row group per source file
        # otherwise limits every scan to a single task).
        df.repartition(32).write.mode("overwrite").parquet(f"{dst}/{name}.parquet")


def main() -> None:
    src, copies, hot = sys.argv[1], int(sys.argv[2]), "--hot" in sys.argv
    os.environ.setdefault("SEGMARK_TMP", tempfile.mkdtemp(prefix="segmark-scale-"))
    from segmark.plans.catalog import QUERIES
    from segmark.session import build_session

    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.driver.memory": os.environ.get("PROBE_DRIVER_MEMORY", "1g")})
    dst = tempfile.mkdtemp(prefix="sfx-", dir=os.environ["SEGMARK_TMP"])
    replicate(spark, src, dst, copies, hot)
    QUERIES["person_features"](spark, src).write.format("noop").mode("overwrite").save()  # warm-up
    out = {"copies": copies, "hot": hot}
    for name in ("person_features", "mart_wide", "train_score_gold"):
        t = time.perf_counter()
        QUERIES[name](spark, dst).write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t, 2)
        print(f"done {name} {out[name]}", file=sys.stderr, flush=True)
    if hot:
        top = QUERIES["person_features"](spark, dst).orderBy(F.desc("num_orders")).first()
        out["hot_person_orders"] = top.num_orders
    print(json.dumps(out))


if __name__ == "__main__":
    main()
