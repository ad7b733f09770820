import random

import numpy as np
import pytest

from segmark.llm import suffix_dedup
from segmark.llm.suffix_dedup import LENGTH, common_prefixes, remove_repeats, suffix_array
from tests.llm.cases import edge_docs, edge_texts, empty_docs


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = {}
    for b in data:
        for i in range(len(b) - LENGTH + 1):
            count[b[i:i + LENGTH]] = count.get(b[i:i + LENGTH], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - LENGTH + 1):
            if count[b[i:i + LENGTH]] > 1:
                gone[i:i + LENGTH] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        out.append((len(b), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def test_suffix_array_and_prefixes_equal_sorting():
    rng = random.Random(3)
    for _ in range(40):
        parts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        size = np.array([len(p) for p in parts])
        off = np.concatenate(([0], np.cumsum(size)))
        text = np.frombuffer(b"".join(parts), np.uint8)
        unit = np.repeat(np.arange(len(parts)), size)
        end = off[1:][unit]
        level = np.array([rng.randint(0, 3) for _ in parts])[unit] + np.arange(len(text)) - off[:-1][unit]
        sa, rank = suffix_array(text, end, unit, level)
        want = sorted(range(len(text)), key=lambda i: (level[i], [x + 1 for x in text[i:end[i]].tolist()] + [int(unit[i]) - 1000]))  # noqa: B023
        assert sa.tolist() == want and (rank[sa] == np.arange(len(text))).all()
        before, prefix = common_prefixes(text, end, level, sa)
        for j, i in enumerate(sa.tolist()):
            p = sa[j - 1] if j and level[sa[j - 1]] == level[i] else -1
            n = 0
            while p >= 0 and i + n < end[i] and p + n < end[p] and text[i + n] == text[p + n]:
                n += 1
            assert (before[i], prefix[i]) == (p, n)


def planted():
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghij klmé") for _ in range(n))
    passage, other = noise(420), noise(260)
    line = noise(80)
    texts = [noise(300) + passage + noise(150), passage[5:] + noise(90), noise(30) + passage[:-7], noise(500) + other[:230], other[20:] + noise(10)]
    texts += [noise(60) + line + noise(60) for _ in range(60)]  # a common line, too short to go
    near = noise(700)
    for _ in range(40):  # near copies: one letter differs somewhere
        i = rng.randrange(len(near))
        texts.append(near[:i] + "Z" + near[i + 1:])
    texts += [other[:199], other[:200], passage * 3, "ab" * 300, "q" * 199, "q" * 200, "q" * 201, "r" * 250]
    return texts


@pytest.mark.parametrize("shard_contexts", [4000, 7])
def test_removed_bytes_equal_brute_force(spark, shard_contexts):
    texts = planted() + [t for t in edge_texts() if len(t or "") < 20_000]
    rows = [(i, t, i % 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, SPANS int")
    got = {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in remove_repeats(df, shard_contexts=shard_contexts).collect()}
    for i, want in enumerate(brute(texts)):
        assert got[i] == want, (i, texts[i][:60] if texts[i] else texts[i])


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = edge_docs(spark)
    got = remove_repeats(df).collect()
    assert len(got) == df.count() and sum(r.doc_id is None for r in got) == 1
    assert {len(r.kept) for r in got if r.doc_id in (5, 6)} == {0}
    assert remove_repeats(empty_docs(spark)).count() == 0


def test_anchors_cover_every_window():
    rng = random.Random(2)
    data = np.frombuffer(bytes(rng.choice(b"abc ") for _ in range(5000)), np.uint8)
    off = np.array([0, 100, 100, 299, 1000, 5000])
    a = suffix_dedup.anchors(data, off)
    for d, (i, j) in enumerate(zip(off[:-1], off[1:], strict=True)):
        own = a["pos"][a["doc"] == d]
        for s in range(j - i - LENGTH + 1):
            assert ((own >= s) & (own + suffix_dedup.GRAM <= s + LENGTH)).any()
        assert j - i >= LENGTH or not len(own)
