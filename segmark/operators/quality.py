"""Data-quality checks (Q1-Q10). Each returns its violations (or a status row) as a
DataFrame, so a check is just another query; zero rows means pass."""
from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_summary(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL counts for several columns in one pass (one global aggregate, no shuffle
    of rows): (table_name, column_name, violations)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, violations)").select(
        F.lit(table).alias("table_name"), "column_name", "violations"
    )


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, NULL keys skipped (Q2, Q9)."""
    k = list(keys)
    cond = None
    for c in k:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*k).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def mart_summary(df: DataFrame, table: str, key: str, label: str) -> DataFrame:
    """One row of a mart's declared checks: persons, repeated persons, missing keys and labels
    (no label column: none missing). Two aggregates: per key, then over the keys."""
    no_label = F.col(label).isNull() if label in df.columns else F.lit(False)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(no_label).alias("gaps"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.count_if(known).alias("persons"),
        F.count_if(known & (F.col("n") > 1)).cast("int").alias("repeated"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).cast("int").alias("missing_keys"),
        F.coalesce(F.sum("gaps"), F.lit(0)).cast("int").alias("missing_labels"),
    ).select(F.lit(table).alias("table_name"), "persons", "repeated", "missing_keys", "missing_labels")


def mart_violations(df: DataFrame, table: str, key: str, label: str) -> DataFrame:
    """Persons of a mart that are repeated or lack a label, with both counts."""
    no_label = F.col(label).isNull() if label in df.columns else F.lit(False)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("occurrences"), F.count_if(no_label).cast("int").alias("missing_labels"))
    return per_key.where((F.col("occurrences") > 1) | (F.col("missing_labels") > 0)).select(
        F.lit(table).alias("table_name"), key, "occurrences", "missing_labels")


def relationship_violations(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    parent_keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.where(F.col(key).isNotNull()).join(parent_keys, F.col(key) == F.col("_pk"), "left_anti")


def accepted_values_violations(
    df: DataFrame, column: str, accepted: Sequence[str], severity: str = "warn"
) -> DataFrame:
    """Values outside the accepted set, with counts and the check's severity (Q4)."""
    return (
        df.where(~F.col(column).isin(list(accepted)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .withColumn("severity", F.lit(severity))
    )


def coverage_violations(dim: DataFrame, fct: DataFrame, key: str = "customer_unique_id") -> DataFrame:
    """Dimension rows without a fact row."""
    return dim.select(key).join(fct.select(key), key, "left_anti")


def _ntz(value) -> Column:
    """A wall-clock timestamp literal without time zone (string -> TIMESTAMP_NTZ), so the
    result does not depend on the session or the Python process time zone."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def freshness(
    df: DataFrame,
    ts_col: str,
    as_of: Sequence[dt.datetime | str],
    warn_hours: float = 36,
    error_hours: float = 72,
) -> DataFrame:
    """Source freshness (Q6): age of the newest row at each as-of time -> pass / warn /
    error. One global aggregate; the as-of times fan out from its single row. Ages are
    computed on wall-clock (zone-free) timestamps."""
    newest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    at = F.explode(F.array(*[_ntz(t) for t in as_of])).alias("as_of")
    micros = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at").cast("timestamp_ntz"), F.col("as_of"))
    age_h = micros / 3.6e9
    return (
        newest.select(at, "max_loaded_at")
        .withColumn("age_hours", F.round(age_h, 6))
        .withColumn(
            "status",
            F.when(F.col("age_hours") > error_hours, "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"),
        )
    )


def reconcile_counts(labelled: DataFrame) -> DataFrame:
    """Headline reconciliation (Q7) in one aggregate over the person rows: orders
    (= sum of per-person order counts), persons, repeat customers, distinct segments."""
    return labelled.agg(
        F.sum("num_orders").cast("long").alias("orders"),
        F.count(F.lit(1)).alias("persons"),
        F.sum("is_repeat_customer").cast("long").alias("repeat_customers"),
        F.count_distinct("segment_label").alias("segments"),
    )


def bounds_violations(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """Rows with ``column`` outside [lo, hi] or NULL (Q8)."""
    return df.where(~F.coalesce(F.col(column).between(lo, hi), F.lit(False)))


def grain_check(df: DataFrame, key: str) -> DataFrame:
    """One row per key (Q9): rows vs distinct keys in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def length_violations(df: DataFrame, column: str, max_len: int) -> DataFrame:
    """Values longer than ``max_len`` characters (Q10)."""
    return df.where(F.length(column) > max_len)


def reconcile_load(lines: DataFrame, kept: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Q7 on a load: one row; lines read = rows kept + lines quarantined.

    ``lines`` counts the data lines of each source file (``raw.data_lines``), independently of the parser.
    """
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    read = lines.agg(F.coalesce(F.sum("n_lines"), F.lit(0)).cast("long").alias("n_read"))
    sums = read.select("n_read", one(kept, "n").scalar().alias("n_kept"), one(quarantined, "n").scalar().alias("n_quarantined"))
    return sums.withColumn("reconciled", F.col("n_read") == F.col("n_kept") + F.col("n_quarantined"))
