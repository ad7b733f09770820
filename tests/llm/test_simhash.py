import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from segmark.llm import simhash
from segmark.llm.components import connected_components
from segmark.llm.simhash import drop_near_copies, fingerprints, simhash_components
from segmark.llm.textblocks import block_of
from tests.llm.cases import DOCS, edge_docs, edge_texts, empty_docs, sentence


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_components(ids, prints):
    parent = {f: f for f in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(set(prints))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if bin(a ^ b).count("1") <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, f in zip(ids, prints, strict=True):
        r = find(f)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(find(f)) for f in prints]


def test_fingerprints_equal_brute_force():
    texts = [t for t in edge_texts() if len(t or "") < 20_000] + ["AbC dEf", "x " * 5, "a b c d", "É é"]
    got = fingerprints(block_of(pa.array(texts, pa.string())))
    assert [int(x) for x in got] == [brute_print(t) for t in texts]


def test_bits_are_counted_without_a_row_of_64_each(monkeypatch):
    """Also where a text has more equal shingles than one count of 16 bits holds."""
    monkeypatch.setattr(simhash.np, "unpackbits", None)
    rng = random.Random(20)
    texts = ["a " * 70_000, " ".join(rng.choice("abcdef") for _ in range(66_000)), "", "a b", *(sentence(rng, 30) for _ in range(40))]
    assert fingerprints(block_of(pa.array(texts))).tolist() == [brute_print(t) for t in texts]


def _rows(points):
    masks = np.array(simhash._route_masks(), np.uint64)
    route = ((points & np.uint64((1 << simhash.ROUTE_BITS) - 1))[:, None] ^ masks).ravel()
    fp = np.repeat(points, len(masks))
    order = np.argsort(route, kind="stable")
    return route[order].view(np.int64), fp[order].view(np.int64)


def test_ball_finds_exactly_the_components_whatever_the_batches(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    points = [base]
    for flips in (1, 3, 4, 5):
        x = base.copy()
        for _ in range(flips):
            x ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        points.append(x)
    hot = base[0] ^ (np.uint64(1) << np.arange(16, 64, dtype=np.uint64))  # many in one route
    points = np.unique(np.concatenate([*points, hot]))
    want = brute_components([int(p) for p in points], [int(p) for p in points])
    route, fp = _rows(points)
    for most, rows in ((2_000_000, 10_000), (20_000, 700), (1500, 300)):
        monkeypatch.setattr(simhash, "MAX_VARIANTS", most)
        batches = [pa.RecordBatch.from_arrays([pa.array(route[i:i + rows]), pa.array(fp[i:i + rows])], names=["route", "fp"])
                   for i in range(0, len(route), rows)]
        parent = {int(p): int(p) for p in points}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for b in simhash._meet(iter(batches)):
            for a, c in zip(*(x.to_numpy().view(np.uint64).tolist() for x in b.columns), strict=True):
                assert bin(a ^ c).count("1") <= 4
                x, y = find(a), find(c)
                parent[max(x, y)] = min(x, y)
        assert [find(int(p)) for p in points] == want


def test_components_of_documents(spark):
    rng = random.Random(9)
    long = sentence(rng, 400)
    near = [long.replace(" ", "  ", 3), long.upper(), long + " tail", long + " tail end"]
    df = edge_docs(spark).union(spark.createDataFrame([(100 + i, t, "en", "s", 0) for i, t in enumerate([long, *near])], DOCS))
    rows = df.collect()
    got = simhash_components(df).collect()
    assert len(got) == len(rows)
    prints = [brute_print(r.text) for r in rows]
    want = sorted(((r.doc_id is None, r.doc_id or 0), f"{p:016x}", c) for r, p, c in
                  zip(rows, prints, brute_components([r.doc_id for r in rows], prints), strict=True))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.fingerprint, r.component_id) for r in got) == want
    kept = drop_near_copies(df.withColumnRenamed("lang", "fingerprint"))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, {c for *_, c in want}))
    assert simhash_components(empty_docs(spark)).count() == 0 and drop_near_copies(empty_docs(spark)).count() == 0


def test_connected_components_on_chains_stars_and_nulls(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    edges = chain + star + star + [(5000, 5000), (None, 3), (7, None), (-4, 2000), (2000, -9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}, -4: -9, -9: -9, 2000: -9}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_a_component_with_null_and_repeated_ids(spark):
    rng = random.Random(10)
    a, b, c, d = (sentence(rng, 300) for _ in range(4))
    rows = [(7, a), (None, a.upper()), (None, a + "  "), (7, a.replace(" ", "  ", 2)),  # one component, id 7 twice and two null ids
            (None, b), (None, b.upper()), (None, b),  # null ids alone
            (8, c), (8, c.upper()), (9, c), (8, d)]  # id 8 in two components
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    root = {t: brute_components(range(len(rows)), [brute_print(x) for _, x in rows])[k] for k, (_, t) in enumerate(rows)}
    assert len(set(root.values())) == 4
    kept = drop_near_copies(df).collect()
    assert sorted((root[r.text], r.doc_id) for r in kept) == [(0, 7), (4, None), (7, 8), (10, 8)]


def test_a_column_named_like_the_mark_stays(spark):
    from segmark.llm.simhash import drop_near_copies

    df = spark.createDataFrame([(1, "a b c d e f", "m1"), (2, "a b c d e f", "m2"), (3, "other words are here now", "m3")], "doc_id long, text string, _near_mark string")
    assert sorted((r.doc_id, r._near_mark) for r in drop_near_copies(df).collect()) == [(1, "m1"), (3, "m3")]
