"""Key checks on tables that grow load by load (Q2, Q3, Q9), without reading the history again.

Each load is written in buckets of its key's hash, and with every bucket goes a digest: the sorted
64-bit hashes of its distinct keys, and its row count. A new load's digests are joined with the older
ones by bucket; only partitions (load and bucket) whose digests share a hash can hold the same key,
and only they are read for the exact comparison. The violations found so far are kept with the table,
so that after each load they are those of a full check.

Choose ``buckets`` so that a load's bucket holds at most about a million keys: a digest is one array.
A key with a null column is not checked, as in the full checks. A load number is written once; running
a load that died again replaces what it left.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.sinks import writers

DIGEST = "load int, bucket int, n_rows long, n_keys long, hashes array<long>"


def _at(root: str, *parts: object) -> str:
    return "/".join([root.rstrip("/"), *map(str, parts)])


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _whole_key(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def write_load(df: DataFrame, root: str, keys: Sequence[str], load: int, buckets: int) -> DataFrame:
    """Write a load in buckets with its digests; returns the digests."""
    spark = df.sparkSession
    path = _at(root, "rows", f"load={load}")
    h = key_hash(keys)
    dealt = df.withColumns({"_hash": F.when(_whole_key(keys), h), "_bucket": F.pmod(h, F.lit(buckets)).cast("int")})
    writers.write_table(dealt, path, partition_by=["_bucket"])
    rows = spark.read.schema(dealt.schema).parquet(path)
    own = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_set("_hash")).alias("hashes"))
    out = own.select(F.lit(load).alias("load"), F.col("_bucket").cast("int").alias("bucket"), "n_rows", F.size("hashes").cast("long").alias("n_keys"), "hashes")
    writers.write_table(out, _at(root, "digests", f"version={load}"))
    return spark.read.schema(DIGEST).parquet(_at(root, "digests", f"version={load}"))


def digests(spark: SparkSession, root: str, loads: Sequence[int]) -> DataFrame:
    reader = spark.read.schema(DIGEST)
    return reader.parquet(*[_at(root, "digests", f"version={n}") for n in loads]) if loads else spark.createDataFrame([], DIGEST)


def meeting(new: DataFrame, old: DataFrame) -> list[tuple[int, int]]:
    """(load, bucket) of the old partitions that share a key hash with the new digests of their bucket."""
    wanted = new.select("bucket", F.col("hashes").alias("own"))
    hit = old.join(wanted, "bucket").where(F.arrays_overlap("hashes", "own")).select("load", "bucket").distinct()
    return sorted((r["load"], r["bucket"]) for r in hit.collect())  # partition names, not rows


def read_partitions(spark: SparkSession, root: str, parts: Sequence[tuple[int, int]], schema) -> DataFrame:
    """Rows of the named partitions; no other file is listed or read."""
    reader = spark.read.schema(schema)
    return reader.parquet(*[_at(root, "rows", f"load={n}", f"_bucket={b}") for n, b in parts]) if parts else spark.createDataFrame([], schema)


def check_load(df: DataFrame, root: str, keys: Sequence[str], load: int, buckets: int = 16) -> list[tuple[int, int]]:
    """Add a load (numbered from 0) and bring the stored violations of Q2 up to date.

    Returns the older partitions that were read.
    """
    spark = df.sparkSession
    new = write_load(df, root, keys, load, buckets)
    met = meeting(new, digests(spark, root, range(load)))
    rows = spark.read.schema(df.schema).parquet(_at(root, "rows", f"load={load}")).select(*keys).where(_whole_key(keys))
    named = rows.distinct()
    older = read_partitions(spark, root, met, rows.schema).join(named, list(keys), "left_semi")
    again = rows.unionByName(older).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    if load:
        again = again.unionByName(violations(spark, root, load - 1).join(named, list(keys), "left_anti"))
    writers.write_table(again, _at(root, "violations", f"version={load}"))
    return met


def violations(spark: SparkSession, root: str, load: int) -> DataFrame:
    """Q2 on all loads up to ``load``: the repeated keys and how often they occur."""
    return spark.read.parquet(_at(root, "violations", f"version={load}"))


def grain(spark: SparkSession, root: str, load: int) -> DataFrame:
    """Q9 on all loads up to ``load`` from digests and violations alone: rows, distinct keys, duplicates.

    A row whose key has a null column counts as a key of its own.
    """
    more = violations(spark, root, load).agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("long").alias("d")).scalar()
    rows = digests(spark, root, range(load + 1)).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("rows"))
    return rows.select("rows", (F.col("rows") - more).alias("distinct_keys"), more.alias("duplicates"))


def orphans(child: DataFrame, key: str, root: str, parent_key: str, loads: Sequence[int], buckets: int = 16) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Q3 against a parent table of loads: rows of ``child`` whose key is in none of them, and the parent
    partitions that were read. Null keys are no violation.

    A key whose hash is in no digest is missing for certain; the others are compared with the rows.
    """
    spark = child.sparkSession
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    asked = child.where(F.col(key).isNotNull()).select(bucket.alias("bucket"), F.xxhash64(F.col(key)).alias("h"))
    own = asked.groupBy("bucket").agg(F.collect_set("h").alias("hashes"))
    met = meeting(own, digests(spark, root, loads))
    schema = child.select(F.col(key).alias(parent_key)).schema
    there = read_partitions(spark, root, met, schema).select(F.col(parent_key).alias("_there"))
    return child.where(F.col(key).isNotNull()).join(there, F.col(key) == F.col("_there"), "left_anti"), met
