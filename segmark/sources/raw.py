"""Raw order rows: fixed schema, CSV readers and the load timestamp."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.functions.scalar import typed_null
from pyspark.sql.types import StringType, StructField, StructType

# One row = one order (customer_id); the person is customer_unique_id. All strings:
# the zip prefix stays a string so leading zeros survive.
RAW_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), False),
        StructField("customer_unique_id", StringType(), False),
        StructField("customer_zip_code_prefix", StringType(), True),
        StructField("customer_city", StringType(), True),
        StructField("customer_state", StringType(), True),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lenient typed scan (S1): header, ``"`` quote/escape, malformed rows dropped.

    Column pruning is switched off for this reader: with DROPMALFORMED, which rows
    count as malformed would otherwise depend on the columns a query needs, so a
    ``count()`` and a full select could disagree.
    """
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", "false")
        .csv(path)
    )


def read_raw_csv_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Strict bulk load (S2): header skipped, optional quotes, '' and 'NULL' -> NULL,
    any malformed row aborts the job."""
    df = (
        spark.read.schema(RAW_SCHEMA)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.select(
        *[F.when(F.col(c).isin("", "NULL"), typed_null("string")).otherwise(F.col(c)).alias(c) for c in RAW_COLUMNS]
    )


# ---- lenient reading that loses nothing ---------------------------------------------------
CORRUPT = "_corrupt_record"


def _reason(record: Column) -> Column:
    """Why a line is malformed: an open quote, or a number of fields other than the schema's."""
    outside = F.regexp_replace(record, '"([^"]|"")*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    return (
        F.when(F.contains(outside, F.lit('"')), "open quote")
        .when(fields < len(RAW_COLUMNS), "too few fields")
        .when(fields > len(RAW_COLUMNS), "too many fields")
        .otherwise("unreadable")
    )


@dataclass(frozen=True)
class Landed:
    """A parsed load: the rows kept and the lines quarantined, both read from what was written."""

    kept: DataFrame
    quarantined: DataFrame


def land_raw_csv(spark: SparkSession, path: str | list[str], out: str) -> Landed:
    """Lenient scan (S1) that keeps malformed lines: parsed once and written below ``out``.

    ``kept`` are exactly the rows of ``read_raw_csv``; ``quarantined`` has one row per malformed line:
    source_file, reason, record.
    """
    schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT, StringType(), True)])
    parsed = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .csv(path)
    )
    rows = parsed.select("*", F.col("_metadata.file_path").alias("source_file"), F.col(CORRUPT).isNotNull().alias("malformed"))
    rows.write.mode("overwrite").partitionBy("malformed").parquet(out)
    every = spark.read.schema(rows.schema).parquet(out)
    kept = every.where(~F.col("malformed")).select(*RAW_COLUMNS)
    bad = every.where("malformed").select("source_file", _reason(F.col(CORRUPT)).alias("reason"), F.col(CORRUPT).alias("record"))
    return Landed(kept, bad)


def data_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_file, n_lines): lines of each file that are not blank, without its header."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines.where(F.trim("value") != "").groupBy("source_file").agg((F.count(F.lit(1)) - 1).alias("n_lines"))


def with_loaded_at(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Add ``_loaded_at`` (S3): the load time, or a passed timestamp for reproducibility."""
    ts = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn("_loaded_at", ts)
