"""Helpers shared by the corpus operators: column hygiene and written hand-over tables."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from segmark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` minus columns whose name clashes (in any letter case) with ``names``.

    The operators add result columns; an input column of the same name is replaced.
    """
    taken = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def handover(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage at a table every executor can reread, so that a lost executor costs a
    reread and not a recomputation, and each later branch reads only its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a hand-over table that nothing reads any more."""
    jvm = spark._jvm
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
