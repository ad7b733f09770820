"""K-Means segmentation: invariants on hand-made persons and on sf0.001."""
from __future__ import annotations

import os

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from segmark.operators import kmeans as kmeans_steps
from segmark.operators import ml
from segmark.operators.features import customer_features
from segmark.operators.staging import stage_orders
from segmark.params import ModelParams
from segmark.plans.catalog import _features
from segmark.sinks import writers


@pytest.fixture(scope="module")
def small_features(spark):
    return _features(spark, SF_SMALL).checkpoint()


PERSON = (
    "customer_unique_id string, num_orders long, is_repeat_customer int, num_distinct_states long, "
    "num_distinct_cities long, zip_macro_region int, state_market_share double, region_idx int"
)


def persons(spark, n):
    """Three separate groups of persons with some spread inside each."""
    rows = [(f"p{i:05d}", 1 + 4 * (i % 3 == 1) + i % 2, int(i % 3 == 1), 1 + (i % 3 == 1), 1 + i % 4, i % 10, 0.05 + 0.4 * (i % 3 == 2), i % 3 * 2)
            for i in range(n)]
    return spark.createDataFrame(rows, PERSON)


def test_gold_has_one_labelled_row_per_person(raw_df):
    feats = customer_features(stage_orders(raw_df))
    result = ml.train(feats, ModelParams(k=3, max_iter=10))
    gold = ml.score(result.model, feats, "v7")
    rows = {r.customer_unique_id: r for r in gold.collect()}
    assert set(rows) == {"mila", "otto", "rute", "ugo", "vera"} and gold.columns == ml.GOLD_COLUMNS
    want = {r.segment_id: r.segment_label for r in ml.cluster_labels(gold).collect()}
    assert all(r.segment_label == want[r.segment_id] and r.model_version == "v7" for r in rows.values())


def test_model_does_not_depend_on_the_layout(spark):
    """Persons in 2, 16 and 512 partitions, in other orders and under other session settings."""
    feats = persons(spark, 3000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for parts, shuffle, order in ((2, "2", "num_orders"), (16, "8", "zip_macro_region"), (512, "64", "customer_unique_id")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            r = ml.train(feats.orderBy(order).repartition(parts), ModelParams(k_search_min=3, k_search_max=5, max_iter=20))
            ids = {x.customer_unique_id: x.segment_id for x in r.model.transform(feats).collect()}
            seen.append((r.k, [tuple(map(float, c)) for c in r.model.stages[-1].clusterCenters()], ids, r.metrics))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(s == seen[0] for s in seen)


def test_the_sweep_shares_its_passes(spark, monkeypatch):
    """As many aggregates as the longest fit takes steps, and the same fits as one at a time."""
    feats = persons(spark, 2000)
    calls = []
    real = kmeans_steps._measure
    monkeypatch.setattr(kmeans_steps, "_measure", lambda points, fits: calls.append(sorted(fits)) or real(points, fits))
    swept = ml.train(feats, ModelParams())
    assert calls[0] == list(range(3, 9)) and len(calls) == dict(swept.metrics)["steps"]
    for k in (4, 7):
        one = ml.train(feats, ModelParams(k=k))
        assert dict(swept.metrics)[f"silhouette_k{k}"] == pytest.approx(one.silhouette, abs=1e-12)


def test_steps_are_lloyds_algorithm(spark):
    """Against numpy on the weighted points, from the same seeds; capped steps are measured again."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 3)) + 4 * rng.integers(0, 3, (400, 1)), 6)
    w = rng.integers(1, 6, 400)
    points = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, w)], "x array<double>, w long")
    start = [[float(v) for v in x[i]] for i in (0, 1, 2, 3)]
    for steps in (2, 50):
        fit = kmeans_steps.fit_all(points, {4: start}, steps)[4]
        c = np.array(start)
        for _ in range(steps):
            j = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([np.average(x[j == i], axis=0, weights=w[j == i]) for i in range(4)])
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        j = d.argmin(axis=1)
        assert np.allclose(fit.centres, c, atol=1e-9) and fit.weights == [int(w[j == i].sum()) for i in range(4)]
        assert fit.cost == pytest.approx(float((w * d.min(axis=1)).sum()), rel=1e-9)
        vectors = spark.createDataFrame([(Vectors.dense(a), int(i)) for a, i, n in zip(x, j, w) for _ in range(n)], ["features", "segment_id"])
        assert kmeans_steps.silhouettes(points, {4: fit})[4] == pytest.approx(ml.silhouette(vectors), abs=1e-9)


def test_priorities_sample_rows_by_weight(spark):
    """Over many seeds a point of three quarters of the rows is the first row three times in four."""
    rows = spark.createDataFrame([(f"p{i}", 1 if i % 4 else 0) for i in range(400)], "id string, a int")
    first = [kmeans_steps.distinct_rows(rows, ["a"], "id", seed).orderBy(F.desc("u0")).first()["a"] for seed in range(40)]
    assert 20 <= sum(first) <= 38


def test_a_failed_pass_fails_the_sweep(spark, monkeypatch):
    def broken(points, fits):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(kmeans_steps, "_measure", broken)
    with pytest.raises(RuntimeError, match="executor lost"):
        ml.train(persons(spark, 60), ModelParams(k_search_min=3, k_search_max=5, max_iter=5))


def test_warm_start_keeps_ids(small_features):
    cold = ml.train(small_features, ModelParams(k=5))
    warm = ml.train(small_features, ModelParams(), start=cold.model)
    centres = lambda r: [list(map(float, c)) for c in r.model.stages[-1].clusterCenters()]
    assert warm.k == 5 and dict(warm.metrics)["steps"] == 1.0
    assert np.allclose(centres(cold), centres(warm), atol=1e-8)
    ids = lambda r: {x.customer_unique_id: x.segment_id for x in r.model.transform(small_features).collect()}
    assert ids(cold) == ids(warm)
    grown = ml.train(small_features.where(F.col("num_orders") < 4), ModelParams(k=5), start=cold.model)
    again = kmeans_steps.matched(ml.stored_centres(grown.model)[1], ml.stored_centres(cold.model)[1])
    assert np.allclose(again, ml.stored_centres(grown.model)[1])
    with pytest.raises(ValueError, match="other features"):
        ml.train(small_features, ModelParams(features=("num_orders", "state_market_share")), start=cold.model)


def test_centres_take_the_ids_of_the_nearest_old_ones():
    old = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]
    assert kmeans_steps.matched([[9.0, 1.0], [1.0, 9.0], [0.5, 0.5]], old) == [[0.5, 0.5], [9.0, 1.0], [1.0, 9.0]]
    assert kmeans_steps.matched([[9.0, 1.0], [50.0, 50.0], [1.0, 9.0], [0.5, 0.5]], old) == [[0.5, 0.5], [9.0, 1.0], [1.0, 9.0], [50.0, 50.0]]


def test_assignment_is_nearest_centre(small_features):
    result = ml.train(small_features, ModelParams(k=4))
    out = result.model.transform(small_features)
    centers = [list(c) for c in result.model.stages[-1].clusterCenters()]
    mine = ml.assign_to_centroids(out.drop("segment_id"), centers)
    a = {r.customer_unique_id: r.segment_id for r in out.select("customer_unique_id", "segment_id").collect()}
    b = {r.customer_unique_id: r.segment_id for r in mine.select("customer_unique_id", "segment_id").collect()}
    assert a == b


def test_same_seed_same_result(small_features):
    a = ml.train(small_features, ModelParams(k=3))
    b = ml.train(small_features.orderBy("num_orders"), ModelParams(k=3))
    ca = sorted(tuple(round(x, 9) for x in c) for c in a.model.stages[-1].clusterCenters())
    cb = sorted(tuple(round(x, 9) for x in c) for c in b.model.stages[-1].clusterCenters())
    assert ca == cb


def test_sweep_picks_best_silhouette(small_features):
    r = ml.train(small_features, ModelParams())
    sweep = {k: v for k, v in r.metrics if k.startswith("silhouette_k")}
    assert list(sweep) == [f"silhouette_k{k}" for k in range(3, 9)]
    best = max(sweep.values())
    first_best = min(int(k[len("silhouette_k"):]) for k, v in sweep.items() if v == best)
    assert r.k == first_best and r.silhouette == best
    assert dict(r.metrics)["k_selected"] == r.k and r.training_cost >= 0


def test_degenerate_clusters_score_minus_one(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 3, ["features"])
    m = ml.kmeans(3, 5, 42).fit(df)
    assert sum(1 for s in m.summary.clusterSizes if s > 0) == 1
    assert ml._score_k(m, df) == -1.0  # the evaluator itself would raise here


def test_sweep_survives_degenerate_k(spark):
    rows = [(f"p{i}", 1 + (i % 2), i % 2, 1, 1, 3, 0.5, 3) for i in range(6)]
    df = spark.createDataFrame(
        rows,
        "customer_unique_id string, num_orders long, is_repeat_customer int, num_distinct_states long, "
        "num_distinct_cities long, zip_macro_region int, state_market_share double, region_idx int",
    )
    r = ml.train(df, ModelParams(k_search_min=2, k_search_max=3, max_iter=5))
    assert r.k == 2 and r.silhouette > 0.99 and dict(r.metrics)["silhouette_k3"] == -1.0
    for params in (ModelParams(k=3), ModelParams(k_search_min=3, k_search_max=4)):
        with pytest.raises(ValueError, match="2 distinct points"):
            ml.train(df, params)


def test_null_feature_fails_by_name(spark):
    df = spark.createDataFrame(
        [("a", None, 0, 1, 1, 3, 0.5, 3), ("b", 2, 1, 1, 1, 3, 0.5, 3)],
        "customer_unique_id string, num_orders long, is_repeat_customer int, num_distinct_states long, "
        "num_distinct_cities long, zip_macro_region int, state_market_share double, region_idx int",
    )
    with pytest.raises(Exception, match="num_orders"):
        ml.train(df, ModelParams(k=2, max_iter=5))


def test_zero_variance_scales_to_zero(spark):
    feats = persons(spark, 30).withColumn("num_distinct_states", F.lit(2).cast("long"))
    out = ml.scaled_columns(feats).collect()
    assert {r.num_distinct_states_scaled for r in out} == {0.0}


def test_profile_labels(spark):
    scored = spark.createDataFrame(
        [(0, 2, 1, 0.1), (0, 1, 1, 0.1), (1, 1, 2, 0.1), (2, 1, 1, 0.5), (3, 1, 1, 0.1)],
        "segment_id int, num_orders long, num_distinct_states long, state_market_share double",
    )
    labels = {r.segment_id: r.segment_label for r in ml.label_segments(scored).collect()}
    assert labels == {0: "Recurrente", 1: "Itinerante", 2: "Metropolitano", 3: "Estándar regional"}


def test_model_roundtrip(small_features, tmp_dir):
    r = ml.train(small_features, ModelParams(k=3))
    path = os.path.join(tmp_dir, "model")
    writers.save_model(r.model, path)
    a = r.model.transform(small_features).select("customer_unique_id", "segment_id").collect()
    b = writers.load_model(path).transform(small_features).select("customer_unique_id", "segment_id").collect()
    assert sorted(a) == sorted(b)


def test_scaler_uses_sample_std(spark):
    df = spark.createDataFrame(
        [(f"p{i}", n, 0, 1, 1, 3, 0.5, 3) for i, n in enumerate([1, 2, 3, 6])],
        "customer_unique_id string, num_orders long, is_repeat_customer int, num_distinct_states long, "
        "num_distinct_cities long, zip_macro_region int, state_market_share double, region_idx int",
    )
    got = {r.customer_unique_id: r.num_orders_scaled for r in ml.scaled_columns(df).collect()}
    mean, n = 3.0, 4
    std = (sum((x - mean) ** 2 for x in [1, 2, 3, 6]) / (n - 1)) ** 0.5
    assert got == {f"p{i}": round((x - mean) / std, 6) for i, x in enumerate([1, 2, 3, 6])}


def test_points_are_dealt_as_the_parameters_say(spark, monkeypatch):
    """The number is among the run's metrics, every pass works on so many partitions, and the result is the same."""
    parts, real = [], kmeans_steps.fit_all
    monkeypatch.setattr(kmeans_steps, "fit_all", lambda points, *a: parts.append(points.rdd.getNumPartitions()) or real(points, *a))
    runs = [ml.train(persons(spark, 600), ModelParams(k=4, max_iter=20, layout_partitions=n)) for n in (3, 16)]
    assert parts == [3, 16] == [dict(r.metrics)["layout_partitions"] for r in runs]
    centres = [[list(map(float, c)) for c in r.model.stages[-1].clusterCenters()] for r in runs]
    assert centres[0] == centres[1]
