"""BI reports on hand-made person rows."""
from __future__ import annotations

from segmark.operators import reports


def _people(spark):
    return spark.createDataFrame(
        [
            ("a", 3, 1, "Sudeste", "SP", "Recurrente", "Recurrente alto"),
            ("b", 1, 0, "Sudeste", "SP", "Metropolitano", "Metropolitano"),
            ("c", 1, 0, "Sul", "RS", "Estándar regional", "Estándar regional"),
            ("d", 2, 1, None, None, "Recurrente", "Recurrente"),
        ],
        "customer_unique_id string, num_orders long, is_repeat_customer int, primary_region string, "
        "primary_state string, segment_label string, segment_label_rule string",
    )


def test_counts_and_rates(spark):
    df = _people(spark)
    assert {(r.primary_region, r.is_repeat_customer, r.customers) for r in reports.region_repeat_counts(df).collect()} == {
        ("Sudeste", 1, 1), ("Sudeste", 0, 1), ("Sul", 0, 1), (None, 1, 1)
    }
    assert [(r.num_orders, r.customers) for r in reports.frequency_histogram(df).collect()] == [(1, 2), (2, 1), (3, 1)]
    assert {(r.segment_label, r.customers) for r in reports.segment_distribution(df).collect()} == {
        ("Recurrente", 2), ("Metropolitano", 1), ("Estándar regional", 1)
    }
    rates = {r.primary_region: (r.customers, r.repeat_rate) for r in reports.repeat_rate_by_region(df).collect()}
    assert rates == {"Sudeste": (2, 0.5), "Sul": (1, 0.0), None: (1, 1.0)}
    agree = {(r.segment_label, r.segment_label_rule): r.customers for r in reports.model_vs_rule(df).collect()}
    assert agree[("Recurrente", "Recurrente alto")] == 1 and sum(agree.values()) == 4


def test_share_ranking_ties(spark):
    shares = spark.createDataFrame(
        [("SP", 2, 0.4), ("RJ", 1, 0.2), ("BA", 1, 0.2), (None, 1, 0.2)],
        "customer_state string, state_orders long, state_market_share double",
    )
    ranks = [(r.customer_state, r.share_rank) for r in reports.share_ranking(shares).collect()]
    assert sorted(ranks, key=str) == sorted([("SP", 1), ("BA", 2), ("RJ", 2), (None, 2)], key=str)
