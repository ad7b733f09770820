"""Dimension, fact and wide mart (L5) with model-or-rule resolution (M9)."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from segmark.functions.scalar import SOURCE_MODEL, SOURCE_RULES, UNKNOWN_INT, rule_label

P = "customer_unique_id"

ML_SCHEMA = StructType(
    [
        StructField("customer_unique_id", StringType(), True),
        StructField("segment_id", IntegerType(), True),
        StructField("segment_label", StringType(), True),
    ]
)

DIM_COLUMNS = [
    "customer_unique_id",
    "primary_customer_id",
    "primary_state",
    "primary_region",
    "region_idx",
    "zip_macro_region",
    "num_orders",
    "is_repeat_customer",
    "num_distinct_states",
    "num_distinct_cities",
    "state_market_share",
]
FACT_COLUMNS = [
    "customer_unique_id",
    "primary_customer_id",
    "segment_id",
    "segment_label",
    "segment_source",
    "model_version",
    "scored_at",
]
MART_COLUMNS = [
    "customer_unique_id",
    "primary_customer_id",
    "primary_state",
    "primary_region",
    "zip_macro_region",
    "num_orders",
    "is_repeat_customer",
    "num_distinct_states",
    "num_distinct_cities",
    "state_market_share",
    "segment_id",
    "segment_label",
    "segment_source",
    "model_version",
    "scored_at",
]


def scored_at_col(scored_at: dt.datetime | str | None) -> Column:
    """The scoring time: wall clock by default, or a passed value for reproducible runs."""
    if scored_at is None:
        return F.current_timestamp()
    return F.lit(scored_at).cast("timestamp")


def dim_customers(features: DataFrame) -> DataFrame:
    return features.select(*DIM_COLUMNS)


def _rule_col() -> Column:
    return rule_label(
        F.col("num_orders"), F.col("is_repeat_customer"), F.col("num_distinct_states"), F.col("state_market_share")
    )


def resolve_segments(features: DataFrame, ml: DataFrame, model_version: str, scored_at=None) -> DataFrame:
    """Person features + resolved segment columns (M9), one row per person.

    The rule label is a projection of the same row (no self-join); the model table is
    joined once on the person key. Missing model rows or NULL model labels fall back
    to the rule label; provenance is per row.
    """
    m = ml.select(
        F.col(P).alias("_ml_person"), F.col("segment_id").alias("_ml_id"), F.col("segment_label").alias("_ml_label")
    )
    joined = features.join(m, features[P] == m["_ml_person"], "left")
    return joined.select(
        *[features[c] for c in features.columns],
        F.coalesce(F.col("_ml_id"), F.lit(UNKNOWN_INT)).alias("segment_id"),
        F.coalesce(F.col("_ml_label"), _rule_col()).alias("segment_label"),
        F.when(F.col("_ml_id").isNotNull(), F.lit(SOURCE_MODEL)).otherwise(F.lit(SOURCE_RULES)).alias("segment_source"),
        F.lit(model_version).alias("model_version"),
        scored_at_col(scored_at).alias("scored_at"),
    )


def fct_customer_segments(features: DataFrame, ml: DataFrame, model_version: str, scored_at=None) -> DataFrame:
    return resolve_segments(features, ml, model_version, scored_at).select(*FACT_COLUMNS)


def mart_from_resolved(resolved: DataFrame) -> DataFrame:
    """Wide BI mart (P7) straight from the resolved rows: no dim x fact join needed."""
    return resolved.select(
        *[F.round("state_market_share", 4).alias(c) if c == "state_market_share" else F.col(c) for c in MART_COLUMNS]
    )


def mart_bi(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Wide BI mart as the inner join of materialised dim and fact tables."""
    d = dim.alias("d")
    s = fct.alias("s")
    return d.join(s, F.col("d.customer_unique_id") == F.col("s.customer_unique_id"), "inner").select(
        "d.customer_unique_id",
        "d.primary_customer_id",
        "d.primary_state",
        "d.primary_region",
        "d.zip_macro_region",
        "d.num_orders",
        "d.is_repeat_customer",
        "d.num_distinct_states",
        "d.num_distinct_cities",
        F.round("d.state_market_share", 4).alias("state_market_share"),
        "s.segment_id",
        "s.segment_label",
        "s.segment_source",
        "s.model_version",
        "s.scored_at",
    )


def build_marts(features: DataFrame, ml: DataFrame, model_version: str, scored_at=None) -> dict[str, DataFrame]:
    """dim, fct and mart from one resolved relation (persist it once when writing all three)."""
    resolved = resolve_segments(features, ml, model_version, scored_at)
    return {
        "dim_customers": resolved.select(*DIM_COLUMNS),
        "fct_customer_segments": resolved.select(*FACT_COLUMNS),
        "mart_bi_customer_segments": mart_from_resolved(resolved),
    }
