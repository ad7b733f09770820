"""Key checks by digests give the violations of the full checks and read only what can collide."""
from __future__ import annotations

import random

from pyspark.sql import functions as F

from segmark.operators import digests, quality


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_violations_after_every_load(spark, tmp_dir):
    rng = random.Random(1)
    loads = [[(rng.choice([None, *range(150)]), rng.choice("abc"), i) for i in range(n)] for n in (200, 0, 60, 5)]
    every = []
    for number, load in enumerate(loads):
        every += load
        digests.check_load(spark.createDataFrame(load, "k int, s string, v int"), tmp_dir, ["k", "s"], number, buckets=8)
        whole = spark.createDataFrame(every, "k int, s string, v int")
        full = quality.unique_violations(whole, ["k", "s"])
        assert rows(digests.violations(spark, tmp_dir, number).select(*full.columns)) == rows(full)
    known = spark.createDataFrame(every, "k int, s string, v int")
    g = digests.grain(spark, tmp_dir, 3).first()
    n_null = known.where("k is null").count()
    assert g.rows == len(every) and g.distinct_keys - n_null == known.where("k is not null").select("k", "s").distinct().count()


def test_only_partitions_that_meet_are_read(spark, tmp_dir):
    for number in range(3):
        frame = spark.range(number * 1000, number * 1000 + 1000).select("id")
        assert digests.check_load(frame, tmp_dir, ["id"], number, buckets=8) == []
    bucket = spark.createDataFrame([(1500,)], "id long").select(F.pmod(F.xxhash64("id"), F.lit(8))).first()[0]
    met = digests.check_load(spark.createDataFrame([(1500,), (7777,)], "id long"), tmp_dir, ["id"], 3, buckets=8)
    assert met == [(1, bucket)]
    assert rows(digests.violations(spark, tmp_dir, 3)) == [(1500, 2)]
    back = digests.read_partitions(spark, tmp_dir, met, "id long")
    assert back.count() < 300 and all(f"load=1/_bucket={bucket}" in f for f in back.inputFiles())


def test_relationships_against_loads(spark, tmp_dir):
    for number in (0, 1):
        digests.write_load(spark.range(number * 100, number * 100 + 100).select("id"), tmp_dir, ["id"], number, 4)
    child = spark.createDataFrame([(5, "a"), (250, "b"), (None, "c"), (150, "d"), (250, "e")], "ref long, v string")
    found, met = digests.orphans(child, "ref", tmp_dir, "id", [0, 1], buckets=4)
    assert sorted(r.v for r in found.collect()) == ["b", "e"] and len(met) == 2
    assert digests.orphans(child.where("ref = 250"), "ref", tmp_dir, "id", [0, 1], buckets=4)[1] == []
