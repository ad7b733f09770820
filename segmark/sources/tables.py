"""Columnar and named-table sources."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver-generated parquet table, e.g. ``orders``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columnar dataset scan by format string (S4); column pruning and filters push down."""
    return spark.read.format(fmt).load(path)


def empty_typed(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Typed empty relation (S8): ``select null::type ... where false``.

    Written as a false filter (not as empty local rows) so the optimizer sees an empty
    relation and removes joins against it (PropagateEmptyRelation)."""
    st = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    return (
        spark.range(1)
        .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])
        .where(F.lit(False))
    )


def optional_table(spark: SparkSession, name: str, schema: StructType | str) -> DataFrame:
    """Use ``name`` if it exists, else a typed empty relation with ``schema``.

    The existence probe and the read use the same name (one parameter).
    """
    if spark.catalog.tableExists(name):
        cols = schema.fieldNames() if isinstance(schema, StructType) else [
            c.strip().split()[0] for c in schema.split(",")
        ]
        return spark.table(name).select(*cols)
    return empty_typed(spark, schema)
