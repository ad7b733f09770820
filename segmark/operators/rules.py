"""Rule-based segments (M8): transparent baseline and fallback for the model."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmark.functions.scalar import rule_label


def rule_segments(features: DataFrame) -> DataFrame:
    return features.select(
        "customer_unique_id",
        rule_label(
            F.col("num_orders"),
            F.col("is_repeat_customer"),
            F.col("num_distinct_states"),
            F.col("state_market_share"),
        ).alias("segment_label_rule"),
    )


def with_rule_label(df: DataFrame) -> DataFrame:
    """Append ``segment_label_rule`` to any frame carrying the feature columns."""
    return df.withColumn(
        "segment_label_rule",
        rule_label(
            F.col("num_orders"),
            F.col("is_repeat_customer"),
            F.col("num_distinct_states"),
            F.col("state_market_share"),
        ),
    )
