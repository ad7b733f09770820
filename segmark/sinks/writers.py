"""Sinks and layout (K1-K8)."""
from __future__ import annotations

from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _balanced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys`` in an AQE rebalance: small partitions merge, a skewed one splits (K7)."""
    return df.hint("rebalance", *keys)


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    overwrite: str = "static",
    rebalance: bool | None = None,
) -> None:
    """Write a dataset so that a rerun gives the same state (K1).

    ``overwrite`` says what a rerun replaces: ``'static'`` everything below ``path``,
    ``'dynamic'`` the partitions that ``df`` has rows for (K3). It is an option of this write,
    so concurrent writes in a session do not share it. With ``partition_by`` (K2) the rows are
    rebalanced by those columns first, unless ``rebalance`` says otherwise; without, input
    splits and coalesced shuffles give even files already. The codec is the session's.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError(f"unknown overwrite mode {overwrite!r}")
    keys = list(partition_by or ())
    out = _balanced(df, keys) if (bool(keys) if rebalance is None else rebalance) else df
    options = {"partitionOverwriteMode": overwrite}
    out.write.save(path, format=fmt, mode=mode, partitionBy=keys or None, **options)


def clustered(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None, tiebreak: str | None = "customer_unique_id"
) -> DataFrame:
    """Clustered layout (K6): range-partition and sort by the keys, so every output file
    covers a narrow key range and parquet min/max statistics skip row groups.

    Without ``partitions`` AQE merges the ranges up to its advisory size, so the number of
    files follows the table's bytes, not the session's initial partition count. Range
    partitioning cannot split one key value, so a (region, segment) pair holding a
    third of all rows would land in one huge file; the ``tiebreak`` column (the person id,
    when present) is appended as the last range key so such a group spreads over several
    files while the files stay ordered by the cluster keys."""
    range_keys = list(keys) + ([tiebreak] if tiebreak and tiebreak in df.columns and tiebreak not in keys else [])
    dealt = df.repartitionByRange(partitions, *range_keys) if partitions else df.repartitionByRange(*range_keys)
    return dealt.sortWithinPartitions(*range_keys)


#: Values of a key that decide its split points, at most.
SPLIT_SAMPLE = 4096
#: So many split points are compared one by one.
FEW_SPLITS = 16


def _splits(df: DataFrame, key: str, bits: int) -> list:
    """At most 2^bits - 1 sorted split points: all distinct values but the least, or quantiles of a
    sample of them spread by hash (``SPLIT_SAMPLE`` values at most)."""
    some = df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(F.xxhash64(key)).limit(SPLIT_SAMPLE)
    values = sorted(r[0] for r in some.collect())[1:]
    most = (1 << bits) - 1
    return values if len(values) <= most else [values[(i + 1) * len(values) // (most + 1)] for i in range(most)]


def interleaved_key(df: DataFrame, keys: Sequence[str], bits: int = 8) -> Column:
    """A number whose bits alternate between the keys' positions among their split points (nulls first)."""
    if bits * len(keys) > 62:
        raise ValueError("the keys' bits do not fit a long")
    out = F.lit(0).cast("long")
    for place, key in enumerate(keys):
        splits = _splits(df, key, bits)
        if not splits:
            continue
        points, value = [F.lit(v).cast(df.schema[key].dataType) for v in splits], F.col(key)
        if len(points) <= FEW_SPLITS:  # plain comparisons, which Spark compiles; a lambda it does not
            below = sum(((p <= value).cast("int") for p in points[1:]), (points[0] <= value).cast("int"))
        else:
            below = F.size(F.filter(F.array(*points), lambda p: p <= value))  # noqa: B023
        # A row's position is worked out once; its bits come spread out already.
        spread = [sum((at >> bit & 1) << (bit * len(keys) + len(keys) - 1 - place) for bit in range(bits)) for at in range(len(points) + 1)]
        out = out.bitwiseOR(F.when(value.isNull(), 0).otherwise(F.get(F.array(*[F.lit(v).cast("long") for v in spread]), below)))
    return out


def interleaved(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None, tiebreak: str | None = "customer_unique_id", bits: int = 8
) -> DataFrame:
    """Clustered layout (K6) for filters on any of the keys alone: rows in order of the interleaved key.

    Key order lets min/max statistics skip files for the first key only; here every key's values
    lie in a part of the files. As in ``clustered``, the ``tiebreak`` spreads a group over several files.
    """
    name = "_interleaved"
    while name in df.columns:
        name += "_"
    order = [name, *keys] + ([tiebreak] if tiebreak and tiebreak in df.columns and tiebreak not in keys else [])
    keyed = df.withColumn(name, interleaved_key(df, keys, bits))
    dealt = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop(name)


def files_per_value(written: DataFrame, key: str) -> DataFrame:
    """(value, files_holding, files): files of a written table whose range of ``key`` holds each of its
    values, that is, those a filter on the value has to read."""
    ranges = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    files = ranges.count()
    values = written.where(F.col(key).isNotNull()).select(F.col(key).alias("value")).distinct()
    held = values.join(ranges, (F.col("value") >= F.col("low")) & (F.col("value") <= F.col("high")))
    return held.groupBy(F.col("value").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("files_holding"), F.lit(files).cast("long").alias("files"))


def save_as_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
    sort_by: Sequence[str] | None = None,
) -> None:
    """Catalog table (K4); ``path`` makes it an external table in a shared folder.

    ``bucket_by=(n, key)`` hash-buckets the rows by ``key`` into ``n`` files per task
    output; two tables bucketed the same way join on ``key`` without any shuffle.
    ``sort_by`` sorts each bucket (min/max statistics then prune on those columns)."""
    if bucket_by:
        # Same hash and count as the bucketing: each task then holds exactly one bucket
        # and writes one file for it, instead of one file per bucket per task.
        df = df.repartition(bucket_by[0], bucket_by[1])
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        n, key = bucket_by
        writer = writer.bucketBy(n, key)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)


def materialize(
    df: DataFrame, name: str, how: str = "table", path: str | None = None
) -> DataFrame:
    """K5: 'table' -> catalog table, 'view' -> temp view, 'ephemeral' -> the frame itself."""
    spark: SparkSession = df.sparkSession
    if how == "table":
        save_as_table(df, name, path)
        return spark.table(name)
    if how == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if how == "ephemeral":
        return df
    raise ValueError(f"unknown materialization {how!r}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a hand-over folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def save_model(model: PipelineModel, path: str) -> None:
    """K8."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S10."""
    return PipelineModel.load(path)
