"""Model-or-rule resolution and the three mart tables."""
from __future__ import annotations

import datetime as dt

from conftest import raw

from segmark.operators import marts
from segmark.operators.features import customer_features
from segmark.operators.staging import stage_orders

AT = dt.datetime(2024, 2, 1)


def _feats(spark):
    rows = [
        ("o1", "a", "1", "x", "SP"),
        ("o2", "a", "1", "x", "SP"),
        ("o3", "a", "1", "x", "SP"),
        ("o4", "b", "2", "y", "RJ"),
        ("o5", "c", "3", "z", "SP"),
        ("o6", "d", "4", "w", "BA"),
    ]
    return customer_features(stage_orders(raw(spark, rows)))


def _ml(spark, rows):
    return spark.createDataFrame(rows, marts.ML_SCHEMA)


def test_fallback_without_model_table(spark):
    f = _feats(spark)
    fct = {r.customer_unique_id: r for r in marts.fct_customer_segments(f, _ml(spark, []), "v", AT).collect()}
    assert len(fct) == 4
    assert all(r.segment_id == -1 and r.segment_source == "rule_based" for r in fct.values())
    assert fct["a"].segment_label == "Recurrente alto"
    assert fct["c"].segment_label == "Metropolitano"
    assert fct["d"].segment_label == "Estándar regional"
    assert fct["a"].scored_at == AT and fct["a"].model_version == "v"


def test_partial_model_table_and_null_label(spark):
    f = _feats(spark)
    ml_tab = _ml(spark, [("a", 2, "Recurrente"), ("b", 0, None)])
    fct = {r.customer_unique_id: r for r in marts.fct_customer_segments(f, ml_tab, "v", AT).collect()}
    assert (fct["a"].segment_id, fct["a"].segment_label, fct["a"].segment_source) == (2, "Recurrente", "kmeans")
    # NULL model label -> rule label, but provenance stays with the model row.
    assert (fct["b"].segment_id, fct["b"].segment_label, fct["b"].segment_source) == (0, "Estándar regional", "kmeans")
    assert (fct["c"].segment_id, fct["c"].segment_source) == (-1, "rule_based")


def test_mart_forms_agree(spark):
    f = _feats(spark)
    ml_tab = _ml(spark, [("a", 1, "Recurrente")])
    built = marts.build_marts(f, ml_tab, "v", AT)
    joined = marts.mart_bi(built["dim_customers"], built["fct_customer_segments"])
    assert sorted(map(tuple, built["mart_bi_customer_segments"].collect())) == sorted(map(tuple, joined.collect()))
    assert built["mart_bi_customer_segments"].columns == marts.MART_COLUMNS
    assert len(built["dim_customers"].columns) == 11 and len(built["fct_customer_segments"].columns) == 7


def test_share_rounded_in_mart(spark):
    f = _feats(spark)
    mart = marts.build_marts(f, _ml(spark, []), "v", AT)["mart_bi_customer_segments"]
    assert {round(r.state_market_share, 4) == r.state_market_share for r in mart.collect()} == {True}
