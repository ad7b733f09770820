import random
import re

import numpy as np

from segmark.llm import decontam
from segmark.llm.decontam import build_index, contamination, drop_contaminated, find_near, phrase_positions, proximity_positions
from tests.llm.cases import DOCS, edge_docs, empty_docs, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = split(text)
        if item is not None and w:
            for i in range(max(1, len(w) - 12)):
                windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    out = []
    for text in docs:
        w, hit, found = split(text), set(), set()
        for p, owners in windows.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= owners
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def tables(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((30, 13, 14, 5, 1, 40, 20))]
    items += [(2, items[0][1]), (50, items[5][1]), (51, None), (52, "... !"), (None, sentence(rng, 20)), (53, "Éa Öb 9c " * 6)]
    texts = [sentence(rng, 50) + " " + items[0][1].upper().replace(" ", " -- ") + " " + sentence(rng, 40), items[1][1], items[1][1][:-1], items[5][1] * 2,
             sentence(rng, 400) + " " + items[2][1], sentence(rng, 100) + " " + items[3][1], "Éa Öb 9c " * 9, " ".join(split(items[0][1])[:12])]
    texts += [items[1][1].rsplit(" ", 6)[0], " ".join(items[1][1].split()[-6:])]  # a phrase across two texts is none
    rows = [(1000 + i, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = edge_docs(spark).union(spark.createDataFrame(rows + rows[:1], DOCS))
    return df, spark.createDataFrame(items, "item_id long, text string"), items


def test_hits_equal_brute_force(spark, monkeypatch):
    df, bench, items = tables(spark)
    rows = df.collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows], items), strict=True))
    for block in (decontam.QUERY_BLOCK, 30):  # one block of test phrases, and several
        monkeypatch.setattr(decontam, "QUERY_BLOCK", block)
        got = contamination(df, bench).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got) == want
    clean = sorted(x[0] for x in want if not x[-1])
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in drop_contaminated(df, bench).collect()) == clean


def test_empty_tables(spark):
    df, bench, _ = tables(spark)
    assert contamination(empty_docs(spark), bench).count() == 0
    none = contamination(df, bench.limit(0))
    assert none.count() == df.count() and none.where("n_hit > 0 or contaminated").count() == 0
    assert drop_contaminated(df, bench.limit(0)).count() == df.count()


def test_positions_of_phrases_and_neighbours():
    rng = random.Random(1)
    text = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)]
    lists = {t: np.flatnonzero([x == t for x in text]) for t in set(text)}
    for n in (1, 2, 4):
        for _ in range(20):
            phrase = [rng.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(n)]
            want = [i for i in range(len(text) - n + 1) if text[i:i + n] == phrase]
            assert phrase_positions(lists, phrase).tolist() == want
            rarest = min(set(phrase), key=lambda t: (len(lists.get(t, ())), t))
            near = proximity_positions(lists, phrase, 3).tolist()
            for i in near:
                assert all(t in text[max(0, i - 3):i + 4] for t in phrase)
            if len(set(phrase)) == 1 and phrase[0] in lists:
                assert near == lists[rarest].tolist()


def test_proximity_search_over_the_index(spark):
    df = spark.createDataFrame([(0, "red x x blue x x green"), (1, "red x x x x x x x x blue green"), (2, "blue green"), (3, "red")], "doc_id long, text string")
    index = build_index(df, "text", ("doc_id",))
    row = {r.row: r.doc_id for r in index.where("row is not null").collect()}
    got = find_near(index, [b"red", b"blue", b"green"], 6)
    assert {row[r.row] for r in got.collect()} == {0}
