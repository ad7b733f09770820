"""BI reports over the person table (A7, A8, A10-A13) and model-vs-rule agreement."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def region_repeat_counts(features: DataFrame) -> DataFrame:
    """Persons by region x repeat flag."""
    return features.groupBy("primary_region", "is_repeat_customer").agg(F.count(F.lit(1)).alias("customers"))


def frequency_histogram(features: DataFrame) -> DataFrame:
    """Persons by number of orders, ascending (A8 + O1)."""
    return features.groupBy("num_orders").agg(F.count(F.lit(1)).alias("customers")).orderBy("num_orders")


def segment_distribution(segments: DataFrame) -> DataFrame:
    """Persons by segment label (A10)."""
    return segments.groupBy("segment_label").agg(F.count(F.lit(1)).alias("customers"))


def geo_distribution(features: DataFrame) -> DataFrame:
    """Persons by region and state."""
    return features.groupBy("primary_region", "primary_state").agg(F.count(F.lit(1)).alias("customers"))


def repeat_rate_by_region(features: DataFrame) -> DataFrame:
    """Share of repeat customers per region."""
    return features.groupBy("primary_region").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("is_repeat_customer"), 6).alias("repeat_rate"),
    )


def share_ranking(state_share: DataFrame) -> DataFrame:
    """States by market share (A13); equal shares have equal ranks, the state orders the output.

    The rank is one more than the number of states with more orders. The running count goes
    over the distinct order counts, not the states: k different positive counts need more than
    k * k / 2 orders, so that table stays small however many state texts there are.
    """
    sizes = state_share.groupBy("state_orders").agg(F.count(F.lit(1)).alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("state_orders")).rowsBetween(Window.unboundedPreceding, -1))
    ranks = sizes.select("state_orders", (F.coalesce(above, F.lit(0)) + 1).alias("share_rank"))
    return state_share.join(ranks, "state_orders").select(
        "customer_state", "state_orders", "state_market_share", "share_rank").orderBy("share_rank", "customer_state")


def model_vs_rule(labelled: DataFrame) -> DataFrame:
    """Agreement matrix of the served label and the rule label.

    Input carries both labels on the person row (see ``with_rule_label``), so no join.
    """
    return labelled.groupBy("segment_label", "segment_label_rule").agg(F.count(F.lit(1)).alias("customers"))
