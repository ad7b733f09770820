"""Incremental file load: each landed file is loaded exactly once."""
from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException

from segmark.sources.tables import read_dataset
from segmark.streaming.ingest import ingest_new_files


def _land(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_each_file_loaded_once(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"
    _land(landing, "a.csv", [header, "o1,p1,01001,sao paulo,SP", "o2,p1,NULL,,SP"])
    assert ingest_new_files(spark, landing, bronze, ckpt) == 2
    assert ingest_new_files(spark, landing, bronze, ckpt) == 0  # nothing new
    _land(landing, "b.csv", [header, "o3,p2,20000,rio,RJ"])
    assert ingest_new_files(spark, landing, bronze, ckpt) == 1
    rows = {r.customer_id: r for r in read_dataset(spark, bronze).collect()}
    assert sorted(rows) == ["o1", "o2", "o3"]
    assert rows["o2"].customer_zip_code_prefix is None and rows["o2"].customer_city is None
    assert all(r._loaded_at is not None for r in rows.values())


def test_malformed_file_aborts_strict_load(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"
    _land(landing, "bad.csv", [header, "o1,p1,01001,sao paulo,SP", "o2,p2"])
    with pytest.raises(StreamingQueryException, match="bad.csv"):
        ingest_new_files(spark, landing, bronze, ckpt)


def test_a_backlog_is_loaded_in_small_batches_and_counted_whole(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ckpt"))
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state"
    for i in range(7):
        _land(landing, f"f{i}.csv", [header, *[f"o{i}-{j},p{j},01001,x,SP" for j in range(i + 1)]])
    assert ingest_new_files(spark, landing, bronze, ckpt, max_files=2) == 28
    assert read_dataset(spark, bronze).count() == 28
    assert read_dataset(spark, bronze).select("_loaded_at").distinct().count() == 4  # batches
