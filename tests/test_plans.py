"""Physical-plan shape: pruned scans, pushed filters, no Expand / cartesian products,
broadcast only of the static dimension, top-1 as a group limit."""
from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SF_SMALL

from segmark.plans.catalog import QUERIES


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_features_plan_shape(spark):
    p = plan(QUERIES["person_features"](spark, SF_SMALL))
    assert "Expand" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", p))
    assert schemas == {
        "struct<o_orderkey:bigint,o_custkey:bigint>",
        "struct<l_orderkey:bigint,l_suppkey:bigint>",
        "struct<s_suppkey:bigint,s_nationkey:int>",
    }


def executed(df) -> str:
    """The final plan of a run: AQE's initial plan left out."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_features_read_the_orders_once(spark):
    """One scan of the orders and of their line items, one person shuffle of aggregated rows, no
    Expand; the state branch and its total read the same exchange."""
    final = executed(QUERIES["person_features"](spark, SF_SMALL))
    assert final.count("FileScan parquet [o_orderkey") == 1
    assert final.count("FileScan parquet [l_orderkey") == 1
    assert "Expand" not in final and "ReusedExchange" in final and "collect_" not in final
    rollup = executed(QUERIES["person_rollup"](spark, SF_SMALL))
    assert "Expand" not in rollup and rollup.count("FileScan parquet [o_orderkey") == 1


def test_state_lookup_is_broadcast_after_measuring(spark):
    """The person rows meet the states in a broadcast join although nothing hints it."""
    final = executed(QUERIES["person_features"](spark, SF_SMALL))
    top = final[: final.index("REPARTITION_BY_COL")]
    assert "BroadcastHashJoin" in top and "SortMergeJoin" not in top


def test_window_top1_becomes_group_limit(spark):
    assert "WindowGroupLimit" in plan(QUERIES["primary_state_window"](spark, SF_SMALL))


def test_dimension_lookup_is_broadcast(spark):
    p = plan(QUERIES["region_lookup_join"](spark, SF_SMALL))
    assert "Scan ExistingRDD" in p and "BroadcastExchange" in p
    m = plan(QUERIES["region_lookup_map"](spark, SF_SMALL))
    # The map literal replaces the dimension join: one join fewer, no dimension scan.
    tree_m, tree_p = m.split("\n\n")[0], p.split("\n\n")[0]
    joins = lambda t: t.count("HashJoin") + t.count("SortMergeJoin")
    assert joins(tree_m) == joins(tree_p) - 1
    assert "Scan ExistingRDD" not in m


@pytest.mark.parametrize(
    "name",
    [
        "stage_orders",
        "person_features",
        "rule_segment_distribution",
        "fct_segments_with_ml",
        "mart_wide",
        "model_vs_rule",
        "dq_not_null",
        "dq_freshness",
        "dq_reconcile",
        "dq_coverage",
        "share_ranking",
        "label_by_profile",
    ],
)
def test_no_cartesian_products(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_rule_label_needs_no_self_join(spark):
    # Rule labels are a projection of the person row, not a join back to it.
    p = plan(QUERIES["fct_segments_fallback"](spark, SF_SMALL))
    assert p.count("Scan parquet") <= plan(QUERIES["person_features"](spark, SF_SMALL)).count("Scan parquet")


def test_missing_model_table_removes_the_join(spark):
    # The typed empty model table is recognised as empty: no join against it remains.
    from segmark.operators import marts
    from segmark.plans.catalog import _features
    from segmark.sources.tables import empty_typed

    f = _features(spark, SF_SMALL)
    some = spark.createDataFrame([("1", 0, "Recurrente")], marts.ML_SCHEMA)
    empty = empty_typed(spark, marts.ML_SCHEMA)
    tree_empty = plan(marts.fct_customer_segments(f, empty, "v")).split("\n\n")[0]
    tree_some = plan(marts.fct_customer_segments(f, some, "v")).split("\n\n")[0]
    assert tree_empty.count("Join") == tree_some.count("Join") - 1


def _simple_plan(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return [ln for ln in buf.getvalue().splitlines() if ln.strip()]


def test_order_shuffle_is_pre_aggregated(spark):
    # The only shuffle of order rows sits on a partial aggregate, so a hot person is
    # collapsed map-side; the person shuffle carries its result.
    lines = _simple_plan(QUERIES["person_features"](spark, SF_SMALL))
    hits = 0
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning(customer_unique_id" in ln:
            hits += 1
            below = " ".join(lines[i + 1:i + 4])
            assert "Aggregate" in below, below
            assert "REPARTITION_BY_COL" in ln or "partial_" in lines[i + 1], ln
    assert hits >= 2


def test_scale_conf_sizes_partitions():
    from segmark.session import MAX_PARTITIONS, partitions_for, scale_conf

    assert partitions_for(1) == 64 and partitions_for(1024**4) == 4096 and partitions_for(10**18) == MAX_PARTITIONS
    assert scale_conf(100 * 1024**4)["spark.sql.shuffle.partitions"] == "20000"
    assert scale_conf(10 * 1024**4)["spark.sql.shuffle.partitions"] == "4096"


def test_layouts_under_target_settings(spark):
    """Bucket and file counts of the marts do not follow the session's partition count."""
    from segmark.params import PERSON_BUCKETS
    from segmark.session import scale_conf

    assert PERSON_BUCKETS <= 100_000  # the engine's limit on buckets
    before = spark.conf.get("spark.sql.shuffle.partitions")
    n = int(scale_conf(100 * 1024**4)["spark.sql.shuffle.partitions"])
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(n // 10))
        tree = plan(QUERIES["clustered_roundtrip"](spark, SF_SMALL))
        files = int(re.search(r"Location: InMemoryFileIndex", tree) is not None)
        assert files == 1
        got = QUERIES["clustered_roundtrip"](spark, SF_SMALL).inputFiles()
        assert len(got) < 50
        joined = QUERIES["mart_dim_fact_join"](spark, SF_SMALL)
        assert len(joined.inputFiles()) <= 2 * PERSON_BUCKETS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_bucketed_dim_fact_join_has_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(QUERIES["mart_dim_fact_join"](spark, SF_SMALL)).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in tree and "Exchange" not in tree
