"""Features kept up load by load equal a full build, whatever the loads."""
from __future__ import annotations

import os
import random

import pytest
from conftest import raw
from pyspark.sql import functions as F

from segmark.operators import incremental as inc
from segmark.operators.features import FEATURE_COLUMNS, customer_features
from segmark.operators.staging import stage_orders
from segmark.sinks import writers


def orders(rng, n, first=0):
    return [(f"o{first + i:05d}", f"p{rng.randint(0, 60):03d}", rng.choice(["01310", " 4410", "x9", None]), rng.choice(["serra", "SERRA ", "campo", None]),
             rng.choice(["SP", "sp", "BA", "QQ", None])) for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.select(*FEATURE_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_loads(spark, tmp_dir, seed):
    rng = random.Random(seed)
    every = orders(rng, 400)
    rng.shuffle(every)
    cuts = sorted(rng.sample(range(400), 4))
    for load, (a, b) in enumerate(zip([0, *cuts], [*cuts, 400])):
        inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, every[a:b])), load, buckets=3, rows_per_bucket=60)
        assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, every[:b]))))
    assert inc.read_manifest(spark, tmp_dir).buckets > 3
    assert inc.drop_old_versions(spark, tmp_dir) > 0
    assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, every))))


def test_repeated_and_broken_loads(spark, tmp_dir, monkeypatch):
    rng = random.Random(3)
    first, second = orders(rng, 50), orders(rng, 50, first=50)
    inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, first)), 0)
    assert inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, first)), 0) == []
    real = writers.write_table

    def dies(df, path, **kw):
        if "/manifest/" in path:
            raise RuntimeError("driver lost")
        real(df, path, **kw)

    monkeypatch.setattr(inc.writers, "write_table", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, second)), 1)
    assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, first))))
    monkeypatch.setattr(inc.writers, "write_table", real)
    inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, second)), 1)
    assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, first + second))))


def test_a_load_reads_the_buckets_of_its_persons_only(spark, tmp_dir, monkeypatch):
    rng = random.Random(4)
    inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, orders(rng, 600))), 0, buckets=32)
    seen = []
    real = inc.read_buckets
    monkeypatch.setattr(inc, "read_buckets", lambda *a: seen.append(real(*a)) or seen[-1])
    touched = inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, [("z1", "p007", "1", "serra", "SP")])), 1)
    own = spark.createDataFrame([("p007",)], "customer_unique_id string").select(F.pmod(F.xxhash64("customer_unique_id"), F.lit(32))).first()[0]
    assert touched == [own]
    assert {os.path.basename(os.path.dirname(f)) for df in seen for f in df.inputFiles()} == {f"bucket={own}"}
    manifest = inc.read_manifest(spark, tmp_dir)
    assert [v for b, v in enumerate(manifest.versions)] == [1 if b == own else 0 for b in range(32)]


def test_nothing_merged(spark, tmp_dir):
    with pytest.raises(ValueError, match="no load"):
        inc.current_features(spark, os.path.join(tmp_dir, "none"))


def test_many_buckets_share_folders(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(inc, "FOLDERS", 4)
    rng = random.Random(5)
    every = orders(rng, 300)
    inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, every[:200])), 0, buckets=3, rows_per_bucket=10)
    inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, every[200:])), 1, buckets=3, rows_per_bucket=10)
    manifest = inc.read_manifest(spark, tmp_dir)
    assert manifest.buckets > 8 and manifest.folders == 4
    for kind in ("places", "persons"):
        assert len([f for f in os.listdir(os.path.join(tmp_dir, kind, "version=1")) if f.startswith("bucket=")]) == 4
    assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, every))))
    # Loads of one person: rows of other buckets in its folder stay, its own older ones no longer count.
    for load in (2, 3):
        every.append((f"z{load}", "p007", "1", "serra", "SP"))
        seen = inc.merge_load(spark, tmp_dir, stage_orders(raw(spark, every[-1:])), load, rows_per_bucket=1000)
        assert len(seen) == 1
        assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, every))))
    assert inc.drop_old_versions(spark, tmp_dir) > 0
    assert rows(inc.current_features(spark, tmp_dir)) == rows(customer_features(stage_orders(raw(spark, every))))
