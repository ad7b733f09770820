"""Scalar column functions (F1-F16). All JVM-side built-ins; no Python UDFs."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (part of the result contract) ----------------------------------------
LABEL_RECURRENT_HIGH = "Recurrente alto"
LABEL_RECURRENT = "Recurrente"
LABEL_ITINERANT = "Itinerante"
LABEL_METRO = "Metropolitano"
LABEL_STANDARD = "Estándar regional"
ACCEPTED_LABELS = (LABEL_RECURRENT_HIGH, LABEL_RECURRENT, LABEL_ITINERANT, LABEL_METRO, LABEL_STANDARD)

# Rule segments (per person): orders >= 3, repeat flag, states > 1, share > 0.30.
RULE_MIN_ORDERS_HIGH = 3
RULE_MIN_STATES = 1
RULE_MIN_SHARE = 0.30
# Cluster labels (per cluster profile): avg orders > 1.3, avg states > 1.05, avg share > 0.30.
PROFILE_MIN_AVG_ORDERS = 1.3
PROFILE_MIN_AVG_STATES = 1.05
PROFILE_MIN_AVG_SHARE = 0.30

SOURCE_MODEL = "kmeans"
SOURCE_RULES = "rule_based"
UNKNOWN_INT = -1
# ---- end of fixed values -------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_char(c: str | Column) -> Column:
    """``left(x, 1)`` (F1)."""
    return F.substring(col(c), 1, 1)


def safe_int(c: str | Column) -> Column:
    """string -> int, NULL instead of an error for non-digits (F2, ANSI-safe)."""
    return col(c).try_cast("int")


def zip_digit(zip_code: str | Column) -> Column:
    """First zip digit = logistic macro region; NULL when not a digit."""
    return safe_int(first_char(zip_code))


def or_default(c: str | Column, default) -> Column:
    """``coalesce(x, default)``."""
    return F.coalesce(col(c), F.lit(default))


def flag(cond: Column) -> Column:
    """boolean -> 0/1 int (F8)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def typed_null(type_name: str) -> Column:
    """``null::type``."""
    return F.lit(None).cast(type_name)


def rule_label(num_orders: Column, is_repeat: Column, n_states: Column, share: Column) -> Column:
    """Per-person rule segment; first matching branch wins."""
    return (
        F.when(num_orders >= RULE_MIN_ORDERS_HIGH, F.lit(LABEL_RECURRENT_HIGH))
        .when(is_repeat == 1, F.lit(LABEL_RECURRENT))
        .when(n_states > RULE_MIN_STATES, F.lit(LABEL_ITINERANT))
        .when(share > RULE_MIN_SHARE, F.lit(LABEL_METRO))
        .otherwise(F.lit(LABEL_STANDARD))
    )


def profile_label(avg_orders: Column, avg_states: Column, avg_share: Column) -> Column:
    """Per-cluster business label from the cluster's mean profile."""
    return (
        F.when(avg_orders > PROFILE_MIN_AVG_ORDERS, F.lit(LABEL_RECURRENT))
        .when(avg_states > PROFILE_MIN_AVG_STATES, F.lit(LABEL_ITINERANT))
        .when(avg_share > PROFILE_MIN_AVG_SHARE, F.lit(LABEL_METRO))
        .otherwise(F.lit(LABEL_STANDARD))
    )
