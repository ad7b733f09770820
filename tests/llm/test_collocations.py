"""Phrase mining against counting everything in Python."""
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from cases import DOCS, edge_docs, empty_docs, sentence

from segmark.llm import collocations
from segmark.llm.textblocks import block_of

KW = {"support": 5, "top": 40}


def brute(rows, support=30, longest=4, top=2000, percent=80):
    total, count = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            count.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    kept = {p: n for p, n in count.items() if n >= support}
    outer = {}
    for (lang, w), n in kept.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, w[i:i + m])
                outer[key] = max(outer.get(key, 0), n)
    out = {}
    for (lang, w), a in kept.items():
        if len(w) > 1 and 100 * outer.get((lang, w), 0) < percent * a:
            score, _, l, r = min((2_000_000 * a // (count[lang, w[:k]] + count[lang, w[k:]]), k, count[lang, w[:k]], count[lang, w[k:]])
                                 for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top]))


def mined(df, **kw):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in cols) for r in collocations.collocations(df, **kw).collect())


def test_awkward_rows(spark):
    df = edge_docs(spark).withColumnsRenamed({"source": "g", "n_chars": "phrase"})
    want = brute([(r.text, r.lang) for r in df.collect()], **KW)
    assert want
    assert mined(df, **KW) == want


def test_empty(spark):
    assert mined(empty_docs(spark)) == []
    assert mined(spark.createDataFrame([(1, None, None, None, None), (2, " ,. ", "en", None, None)], DOCS)) == []


@pytest.mark.parametrize("shards", [1, 3, 20])
def test_any_number_of_shards_gives_the_same(spark, shards):
    rng = random.Random(2)
    hot = "Alpha beta-x GAMMA Ädelta"
    rows = []
    for i in range(240):
        text = "; ".join(sentence(rng, rng.randint(1, 30)) for _ in range(4))
        rows.append((i % 200, text + (f", {hot}" if i % 3 == 0 else "") + (f"\t{hot} tail\n" if i % 7 == 0 else ""), rng.choice(["en", "de", None]), None, None))
    rows += [(7, f"{hot} {hot}", "en", None, None)] * 120
    df = spark.createDataFrame(rows, DOCS)
    want = brute([(r[1], r[2]) for r in rows], **KW)
    assert any(w[2] == "alpha beta-x gamma Ädelta" for w in want)
    assert mined(df, shards=shards, **KW) == want


def test_a_full_bitmap_only_costs_work(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 8)
    rng = random.Random(3)
    rows = [(i, sentence(rng, 60), "en", None, None) for i in range(100)]
    assert mined(spark.createDataFrame(rows, DOCS), **KW) == brute([(r[1], r[2]) for r in rows], **KW)


def test_long_texts_in_chunks(monkeypatch):
    monkeypatch.setattr(collocations, "TEXT_BYTES", 300)
    rng = random.Random(4)
    for text in (sentence(rng, 900), "x" * 2000 + " " + sentence(rng, 300), sentence(rng, 300) + " " + "y" * 5000, " " * 3000, ", ".join(["a b c d e"] * 300)):
        whole = collocations.Text(block_of(pa.array([text])))
        of = lambda t, own: Counter((k, h) for k, at, hs in t.phrases(4) for h in hs[own[at]].tolist())
        got = Counter()
        for chunk, limit in collocations._chunks(block_of(pa.array([text]))):
            t = collocations.Text(chunk, limit)
            got += of(t, t.own)
        assert got == of(whole, whole.own)


def test_scores_pass_64_bits(spark):
    big = 6 * 10**12
    counts = spark.createDataFrame([("en", 2, "a b", big), ("en", 1, "a", 9 * 10**17), ("en", 1, "b", big)], "lang string, words int, phrase string, n long")
    row = collocations.weakest_cuts(counts, counts.where("words = 2").withColumnRenamed("n", "a")).first()
    assert row.score == 2_000_000 * big // (9 * 10**17 + big) and 2_000_000 * big > 2**63
