"""Nearest neighbours over learned partitions against all distances."""
import math

import numpy as np
import pytest

from segmark.llm import ann
from segmark.llm.queries import QUERIES

ROW = "vec_id long, embedding array<float>, label int, part int, v string, block string"


def table(spark, rows):
    return spark.createDataFrame([(*r, None, 3, "x", "y") for r in rows], ROW)


def results(df, **kw):
    out = {}
    for r in sorted(ann.nearest(df, **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def brute(rows, every=100, k=10):
    """Over usable rows of one length: the k nearest other ids, ties to the smaller id."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in good:
        if i % every == 0:
            d = sorted((float(np.sqrt(((np.array(v, np.float32).astype(float) - np.array(w, np.float32).astype(float)) ** 2).sum())), j)
                       for j, w in good if j != i)
            out[i] = [(n + 1, j, s) for n, (s, j) in enumerate(d[:k])]
    return {i: r for i, r in out.items() if r}


def clouds(n, width=12, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(24, width)) * 6
    return [(i, [float(x) for x in (centre[i * 7 % 24] + rng.normal(size=width)).astype(np.float32)]) for i in range(n)]


def test_awkward_rows_and_ties(spark):
    rows = clouds(60)
    rows += [(100, None), (200, []), (300, [0.0] * 12), (400, [1.0] * 11 + [None]), (500, [float("nan")] * 12), (600, [float("inf")] * 12),
             (None, [1.0] * 12), (700, [1.0] * 12), (701, [1.0] * 12), (700, [1.0] * 12), (800, [2.0] * 5), (900, [-0.0] * 12)]
    rows += [(1000 + i, [0.5] * 12) for i in range(40)]
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 12])
    got = results(table(spark, rows))
    assert set(got) == set(want) == {0, 700, 1000}
    for i in want:
        assert [x[:2] for x in got[i]] == [x[:2] for x in want[i]]
        assert np.allclose([x[2] for x in got[i]], [x[2] for x in want[i]], rtol=0, atol=1e-12)
    assert [x[1] for x in got[1000]] == list(range(1001, 1011))


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.0, 1.0]), (100, [1.0, 1.0])]
    assert {i: [x[1] for x in r] for i, r in results(table(spark, rows)).items()} == {0: [100, 5], 100: [0, 5]}
    assert results(table(spark, [])) == {} and results(table(spark, [(0, None)])) == {} and results(table(spark, [(0, [1.0])])) == {}


def test_recall_with_many_parts_and_a_hot_vector(spark):
    rows = clouds(4000)
    rows += [(10_000 + i, rows[17][1]) for i in range(2000)]
    df = ann.usable_vectors(table(spark, rows))
    index = ann.build_index(df, rows_per_part=128)
    assert index.parts >= 20 and index.router.probes < index.parts
    assert index.rows.select("vec_id").distinct().count() == 4000 + 10  # the copies' eleven smallest ids, one of them row 17
    got = {}
    for r in ann.search(index, df.where("vec_id % 100 = 0"), block_rows=100).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    want = brute(rows)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    kth = {i: w[-1][2] for i, w in want.items()}
    assert np.mean([s <= kth[i] + 1e-9 for i, r in got.items() for s in r.values()]) >= 0.9
    hot = {i: sorted(r) for i, r in got.items() if i >= 10_000}
    assert hot and all(r == [x for x in [17, *range(10_000, 10_011)] if x != i][:10] for i, r in hot.items())


def test_parts_are_balanced_and_cut_fewer_links():
    rng = np.random.default_rng(1)
    x = np.array([r[1] for r in clouds(1500)])
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1)[:, :10]
    part = ann.balanced_parts(x, near, 24)
    cut = lambda p: (p[np.repeat(np.arange(1500), 10)] != p[near.ravel()]).mean()
    assert np.bincount(part, minlength=24).max() <= math.ceil(1.1 * 1500 / 24)
    start = np.zeros(1500, np.int64)
    ann._cut(x, np.arange(1500), 0, 24, start)
    assert cut(part) < cut(start) < cut(rng.integers(0, 24, 1500))


@pytest.mark.parametrize("sf", ["sf0.01", "check_s"])
def test_recall_on_the_given_table(spark, sf):
    path = f"/root/testdata/{sf}"
    a = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    x, ids = np.stack(a.embedding.to_numpy()).astype(float), a.vec_id.to_numpy()
    got = QUERIES["op11_nearest_neighbours"](spark, path).toPandas()
    hit = total = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hit += len(set(ids[order]) & set(g.vec_id))
        total += 10
        assert np.allclose(g.sort_values("rank").score, d[[np.flatnonzero(ids == v)[0] for v in g.sort_values("rank").vec_id]], rtol=0, atol=1e-12)
    assert total == 10 * (ids % 100 == 0).sum() and hit / total >= 0.9
