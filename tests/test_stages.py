"""Stages run alone and chained, handing over through written tables."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import SF_SMALL

from segmark.operators import marts
from segmark.params import Paths, Settings
from segmark.sources.adapter import raw_orders
from segmark.sources.tables import read_dataset
from segmark.plans import stages


def _settings(base):
    paths = Paths.under(base, os.path.join(base, "raw"))
    return Settings(paths=paths).with_model(k=3, max_iter=10)


def test_build_all_and_marts(spark, tmp_dir):
    s = _settings(tmp_dir)
    out = stages.build_all(spark, s, raw=raw_orders(spark, SF_SMALL))
    assert out["features"] == out["gold"] > 0 and out["k"] == 3
    gold = read_dataset(spark, s.paths.gold_segments)
    assert gold.count() == out["gold"]
    assert set(gold.columns) == set(
        "customer_unique_id primary_customer_id num_orders is_repeat_customer num_distinct_states "
        "num_distinct_cities zip_macro_region primary_state primary_region state_market_share segment_id "
        "segment_label model_version scored_at".split()
    )
    assert read_dataset(spark, s.paths.metrics).where("key = 'k_selected'").count() == 1

    at = dt.datetime(2024, 2, 1)
    no_ml = stages.build_marts_stage(spark, s, os.path.join(tmp_dir, "marts0"), scored_at=at)
    fct0 = read_dataset(spark, no_ml["fct_customer_segments"])
    assert fct0.where("segment_source <> 'rule_based'").count() == 0

    n = stages.retrain_stage(spark, s, os.path.join(tmp_dir, "ml_table"))
    assert n == out["features"]
    ml_tab = read_dataset(spark, os.path.join(tmp_dir, "ml_table"))
    with_ml = stages.build_marts_stage(spark, s, os.path.join(tmp_dir, "marts1"), ml_table=ml_tab, scored_at=at)
    mart = read_dataset(spark, with_ml["mart_bi_customer_segments"])
    assert mart.where("segment_source = 'kmeans'").count() == n
    assert sorted(os.listdir(os.path.join(tmp_dir, "marts1"))) == sorted(with_ml)  # nothing beside the marts
    assert mart.columns == marts.MART_COLUMNS


PATHS = {"raw_orders": "/r", "bronze": "/b", "silver_features": "/s", "gold_segments": "/g", "model_dir": "/m", "metrics": "/x"}


def test_settings_env_overrides():
    s = Settings.load({"paths": PATHS, "model_version": "file", "model": {"k": 4}}, env={"MODEL_VERSION": "env"})
    assert s.model_version == "env" and s.model.k == 4 and s.paths.bronze == "/b"
    assert Settings.load({"paths": PATHS}, env={}).model.k is None


@pytest.mark.parametrize("data, word", [
    ({"paths": PATHS, "typo": 1}, "typo"), ({"paths": {**PATHS, "silver": "/q"}}, "silver"), ({"paths": {"bronze": "/b"}}, "raw_orders"),
    ({"paths": PATHS, "spark": {"partitions": 3}}, "partitions"), ({"paths": PATHS, "model": {"clusters": 3}}, "clusters")])
def test_unknown_and_missing_settings_are_errors(data, word):
    with pytest.raises(ValueError, match=word):
        Settings.load(data, env={})


def test_spark_section_reaches_the_session(spark):
    from segmark.session import build_session

    s = Settings.load({"paths": PATHS, "spark": {"shuffle_partitions": 7, "broadcast_bytes": 1234, "extra": {"spark.sql.ansi.enabled": "true"}}}, env={})
    keys = list(s.spark.conf())
    before = {k: spark.conf.get(k, None) for k in keys + ["spark.sql.parquet.compression.codec"]}
    try:
        got = build_session(extra=s.spark.conf())
        assert got.conf.get("spark.sql.shuffle.partitions") == "7"
        assert got.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "1234"
    finally:
        spark.sparkContext.setLogLevel("ERROR")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bronze_carries_the_load_time(spark, tmp_dir):
    s = _settings(tmp_dir)
    at = dt.datetime(2024, 3, 4, 5, 6, 7)
    stages.build_features(spark, s, raw=raw_orders(spark, SF_SMALL), loaded_at=at)
    assert [r[0] for r in read_dataset(spark, s.paths.bronze).select("_loaded_at").distinct().collect()] == [at]


def test_retraining_uses_the_settings_k(spark, tmp_dir):
    s = _settings(tmp_dir)
    stages.build_features(spark, s, raw=raw_orders(spark, SF_SMALL))
    path = os.path.join(tmp_dir, "ml_table")
    for k, want in ((3, 3), (None, stages.RETRAIN_K)):
        stages.retrain_stage(spark, s.with_model(k=k), path)
        assert read_dataset(spark, path).agg({"segment_id": "max"}).first()[0] == want - 1


def test_catalog_mode_joins_features_and_model_table_without_shuffle(spark, tmp_dir):
    import contextlib
    import io
    import uuid

    s = _settings(tmp_dir)
    s = Settings(paths=s.paths, model=s.model, table_prefix=f"segmark_t_{uuid.uuid4().hex[:8]}", person_buckets=4)
    stages.build_features(spark, s, raw=raw_orders(spark, SF_SMALL))
    n = stages.retrain_stage(spark, s, os.path.join(tmp_dir, "ml_table"))
    feats = spark.table(f"{s.table_prefix}_features")
    ml_tab = stages.read_ml_table(spark, s, os.path.join(tmp_dir, "ml_table"))
    assert ml_tab.count() == n == feats.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            marts.resolve_segments(feats, ml_tab, "v").explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    tree = buf.getvalue()
    assert "SortMergeJoin" in tree and "Exchange" not in tree
    out = stages.build_marts_stage(spark, s, os.path.join(tmp_dir, "marts"), ml_table=ml_tab)
    assert read_dataset(spark, out["fct_customer_segments"]).where("segment_source = 'kmeans'").count() == n


def test_stages_are_idempotent_and_metrics_append(spark, tmp_dir):
    s = _settings(tmp_dir)
    raw = raw_orders(spark, SF_SMALL)
    n1 = stages.build_features(spark, s, raw=raw)
    first = sorted(map(tuple, read_dataset(spark, s.paths.silver_features).collect()))
    n2 = stages.build_features(spark, s, raw=raw)
    assert n1 == n2 and sorted(map(tuple, read_dataset(spark, s.paths.silver_features).collect())) == first
    stages.train_stage(spark, s)
    stages.train_stage(spark, s)
    runs = read_dataset(spark, s.paths.metrics).select("run_id").distinct().count()
    assert runs == 2
    at = dt.datetime(2024, 2, 1)
    g1 = stages.score_stage(spark, s, scored_at=at)
    g2 = stages.score_stage(spark, s, scored_at=at, overwrite="dynamic")
    assert g1 == g2 == read_dataset(spark, s.paths.gold_segments).count()


def test_a_killed_build_resumes_after_its_last_stage(spark, tmp_dir, monkeypatch):
    from segmark.params import Paths, Settings
    from segmark.plans import stages

    landing = os.path.join(tmp_dir, "in")
    rows = [(f"o{i}", f"p{i % 40}", str(i * 37 % 100000), f"city {i % 6}", ["SP", "BA", "RJ"][i % 3]) for i in range(120)]
    names = "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"
    spark.createDataFrame(rows, names).write.option("header", True).csv(landing)
    settings = Settings(paths=Paths.under(os.path.join(tmp_dir, "out"), landing)).with_model(k=3)
    real, calls = stages.score_stage, []

    def dies(*a, **kw):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(stages, "score_stage", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        stages.build_all(spark, settings, resume=True)
    monkeypatch.setattr(stages, "score_stage", real)
    for name in ("build_features", "train_stage"):
        monkeypatch.setattr(stages, name, lambda *a, f=getattr(stages, name), n=name, **kw: calls.append(n) or f(*a, **kw))
    again = stages.build_all(spark, settings, resume=True)
    assert again["ran"] == ["score"] and calls == [] and again["gold"] == again["features"] == 40 and again["k"] == 3
    assert stages.build_all(spark, settings, resume=True)["ran"] == []
    # Other parameters rerun what depends on them, new input reruns everything.
    assert stages.build_all(spark, settings.with_model(k=4), resume=True)["ran"] == ["train", "score"]
    spark.createDataFrame([("z", "pz", "1", "x", "SP")], names).write.mode("append").option("header", True).csv(landing)
    last = stages.build_all(spark, settings.with_model(k=4), resume=True)
    assert last["ran"] == ["features", "train", "score"] and last["gold"] == 41
    with pytest.raises(ValueError, match="raw path"):
        stages.build_all(spark, settings, raw=spark.createDataFrame([], names), resume=True)
