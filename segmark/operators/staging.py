"""Staged orders (P4, P8): one cleaned row per order with non-NULL keys."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmark.functions.scalar import zip_digit

STAGED_COLUMNS = [
    "customer_id",
    "customer_unique_id",
    "zip_code_prefix",
    "zip_macro_region",
    "customer_city",
    "customer_state",
]


def not_null_keys(raw: DataFrame) -> DataFrame:
    """Drop rows with a NULL order or person id (P4); pushed to the scan as IsNotNull."""
    return raw.where(F.col("customer_id").isNotNull() & F.col("customer_unique_id").isNotNull())


def stage_orders(raw: DataFrame, clean: bool = True) -> DataFrame:
    """Clean and type raw orders.

    ``clean=True``: zip trimmed and left-padded to 5, macro-region digit taken from the
    trimmed (unpadded) zip, city trimmed and init-capped, state trimmed and upper-cased.
    ``clean=False`` keeps the raw text and takes the digit from the raw zip.
    """
    raw = not_null_keys(raw)
    zip_raw = F.col("customer_zip_code_prefix")
    if not clean:
        return raw.select(
            "customer_id",
            "customer_unique_id",
            zip_raw.alias("zip_code_prefix"),
            zip_digit(zip_raw).alias("zip_macro_region"),
            "customer_city",
            "customer_state",
        )
    zip_t = F.trim(zip_raw)
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.lpad(zip_t, 5, "0").alias("zip_code_prefix"),
        zip_digit(zip_t).alias("zip_macro_region"),
        F.initcap(F.trim("customer_city")).alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
    )
