"""Person features kept up load by load (A1-A5, J1): a stored state that new orders are merged into.

What the features need of an order is a mergeable aggregate per (person, state, city). The state keeps
these rows in buckets by person, beside the person-level rows made of them and the orders per state.
A load aggregates its own orders, rewrites the buckets of the persons it names under its own version,
and then writes a manifest that says which version of each bucket counts. Shares and regions, which
every load changes for everybody, are joined when the features are read: one row per state.

A load that dies before its manifest leaves the state as it was and can be run again; a load number
that the manifest has passed is skipped, so a repeated micro-batch counts once. When buckets hold more
than ``rows_per_bucket`` rows on average, the next load deals all rows into as many buckets as hold
half of that: a bucket's size does not grow with the history, and each row is moved a bounded number of
times on average.

Up to ``FOLDERS`` buckets have a folder each. More of them share folders, sorted by bucket, so that files
follow the rows and not the buckets; a row then names its bucket and version, and rows whose bucket has
moved on to a later version are left out when the folder is read. Such a folder goes when none of its
buckets counts any more.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from segmark.operators import features as feat
from segmark.sinks import writers

BUCKETS = 16
ROWS_PER_BUCKET = 2_000_000
FOLDERS = 64  # so many buckets have folders of their own, whatever their size
FOLDER_ROWS = 1_000_000  # of more buckets, those that share a folder hold about so many rows
PART, VERSION = "_part", "_version"  # bucket and version of a row in a shared folder
PLACE = [feat.P, feat.S, feat.CITY]


@dataclass(frozen=True)
class Manifest:
    """The last load and, per bucket, the version that holds its rows, how many there are, and its folder."""

    load: int
    versions: tuple[int, ...]
    rows: tuple[int, ...]
    folders: int

    def folder(self, bucket: int) -> int:
        return bucket % self.folders

    @property
    def buckets(self) -> int:
        return len(self.versions)


def _at(root: str, *parts: object) -> str:
    return "/".join([root.rstrip("/"), *map(str, parts)])


def read_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest complete manifest below ``root``; None before the first load."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_at(root, "manifest"))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    done = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(folder)
            if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    if not done:
        return None
    rows = spark.read.parquet(_at(root, "manifest", f"load={max(done)}")).orderBy("bucket").collect()  # one row a bucket
    # A manifest without folders is from before buckets shared any.
    folders = rows[0]["folders"] if "folders" in rows[0] else len(rows)
    return Manifest(max(done), tuple(r["version"] for r in rows), tuple(r["n_rows"] for r in rows), folders)


def _paths(root: str, kind: str, manifest: Manifest, buckets: list[int]) -> list[str]:
    places = dict.fromkeys((manifest.versions[b], manifest.folder(b)) for b in buckets if manifest.rows[b])
    return [_at(root, kind, f"version={v}", f"bucket={f}") for v, f in places]


def read_buckets(spark: SparkSession, root: str, kind: str, manifest: Manifest, buckets: list[int], schema) -> DataFrame:
    """Rows of ``kind`` ('places' or 'persons') in the given buckets; no folder of others is listed or read."""
    paths = _paths(root, kind, manifest, buckets)
    if not paths:
        return spark.createDataFrame([], schema)
    if manifest.folders == manifest.buckets:
        return spark.read.schema(schema).parquet(*paths)
    named = StructType([*schema.fields, StructField(PART, IntegerType()), StructField(VERSION, IntegerType())])
    rows = spark.read.schema(named).parquet(*paths)
    if len(buckets) <= FOLDERS:  # skips pages of the sorted files
        rows = rows.where(F.col(PART).isin(buckets))
    live = spark.createDataFrame([(b, manifest.versions[b]) for b in buckets], f"{PART} int, {VERSION} int")  # one row a bucket
    return rows.join(F.broadcast(live), [PART, VERSION], "left_semi").select(*schema.names)


def _merged(places: DataFrame) -> DataFrame:
    return places.groupBy(*PLACE).agg(
        F.sum("cnt").alias("cnt"), F.min("min_customer_id").alias("min_customer_id"), F.max("max_zip_macro_region").alias("max_zip_macro_region"))


def _bucket_of(n: int):
    return F.pmod(F.xxhash64(feat.P), F.lit(n)).cast("int")


def _folders(n: int, rows: int) -> int:
    """Folders of ``n`` buckets that hold so many rows in all."""
    return min(n, max(FOLDERS, rows // FOLDER_ROWS))


def _write_buckets(df: DataFrame, path: str, n: int, folders: int, load: int) -> None:
    """Write ``df`` dealt into ``n`` buckets, a partition per folder."""
    if folders == n:
        writers.write_table(df.withColumn("bucket", _bucket_of(n)), path, partition_by=["bucket"])
        return
    named = df.withColumn(PART, _bucket_of(n)).withColumn(VERSION, F.lit(load)).withColumn("bucket", F.col(PART) % folders)
    sorted_rows = named.hint("rebalance", "bucket").sortWithinPartitions("bucket", PART)
    writers.write_table(sorted_rows, path, partition_by=["bucket"], rebalance=False)


def merge_load(spark: SparkSession, root: str, staged: DataFrame, load: int, buckets: int = BUCKETS,
               rows_per_bucket: int = ROWS_PER_BUCKET) -> list[int]:
    """Merge the staged orders of load number ``load`` (rising, from 0); returns the buckets rewritten.

    ``buckets`` is the number that the first load begins with.
    """
    old = read_manifest(spark, root)
    if old is not None and load <= old.load:
        return []
    fresh_path = _at(root, "load", f"load={load}")
    writers.write_table(feat.place_counts(staged), fresh_path)
    fresh = spark.read.parquet(fresh_path)
    n = old.buckets if old else buckets
    folders = old.folders if old else _folders(n, fresh.count())
    touched = sorted(r[0] for r in fresh.select(_bucket_of(n)).distinct().collect())  # at most one number a bucket
    if old and sum(old.rows) > rows_per_bucket * n:
        n = -(-2 * sum(old.rows) // rows_per_bucket)
        folders = _folders(n, sum(old.rows))
        touched, read = list(range(n)), list(range(old.buckets))
    else:
        read = touched
    before = read_buckets(spark, root, "places", old, read, fresh.schema) if old else spark.createDataFrame([], fresh.schema)
    places = _merged(before.unionByName(fresh))
    new = _at(root, "places", f"version={load}")
    _write_buckets(places, new, n, folders, load)
    placed = spark.read.schema(places.schema).parquet(new)
    _write_buckets(feat.person_level(placed), _at(root, "persons", f"version={load}"), n, folders, load)
    counts = fresh.groupBy(feat.S).agg(F.sum("cnt").alias("state_orders"))
    if old:
        counts = counts.unionByName(spark.read.schema(counts.schema).parquet(_at(root, "states", f"version={old.load}"))).groupBy(feat.S).agg(
            F.sum("state_orders").alias("state_orders"))
    writers.write_table(counts.coalesce(1), _at(root, "states", f"version={load}"))
    size = {r["bucket"]: r["count"] for r in placed.groupBy(_bucket_of(n).alias("bucket")).count().collect()}  # one row a bucket
    same = old if old and n == old.buckets else None
    rows = [(b, load, size.get(b, 0), folders) if b in size or same is None else (b, same.versions[b], same.rows[b], folders) for b in range(n)]
    # The manifest's _SUCCESS file is the commit of the load.
    manifest = spark.createDataFrame(rows, "bucket int, version int, n_rows long, folders int").coalesce(1)
    writers.write_table(manifest, _at(root, "manifest", f"load={load}"))
    writers.remove(spark, fresh_path)
    return touched


def current_features(spark: SparkSession, root: str) -> DataFrame:
    """The features of all orders merged so far, one row per person."""
    manifest = read_manifest(spark, root)
    if manifest is None:
        raise ValueError(f"no load has been merged into {root}")
    every = list(range(manifest.buckets))
    if not sum(manifest.rows):
        raise ValueError(f"the loads merged into {root} had no orders")
    schema = spark.read.parquet(_paths(root, "persons", manifest, every)[0]).drop(PART, VERSION).schema
    persons = read_buckets(spark, root, "persons", manifest, every, schema)
    states = spark.read.parquet(_at(root, "states", f"version={manifest.load}"))
    return feat.feature_rows(persons, feat.described_states(states))


def drop_old_versions(spark: SparkSession, root: str) -> int:
    """Delete the bucket versions and manifests that the newest manifest does not name; returns how many.

    Run it when no reader uses them any more.
    """
    manifest = read_manifest(spark, root)
    if manifest is None:
        return 0
    live = {(v, manifest.folder(b)) for b, v in enumerate(manifest.versions)}
    gone = 0
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    for kind in ("places", "persons"):
        folder = fs_path(_at(root, kind))
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for version in fs.listStatus(folder):
            number = int(version.getPath().getName().split("=")[1])
            for bucket in fs.listStatus(version.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("bucket=") and (number, int(name.split("=")[1])) not in live:
                    fs.delete(bucket.getPath(), True)
                    gone += 1
    for kind, label in (("states", "version"), ("manifest", "load")):
        folder = fs_path(_at(root, kind))
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for f in fs.listStatus(folder):
            if f.getPath().getName() != f"{label}={manifest.load}":
                fs.delete(f.getPath(), True)
                gone += 1
    return gone
