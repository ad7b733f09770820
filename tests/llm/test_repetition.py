import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from segmark.llm.repetition import MAX_WINDOW_PCT, measure, repetition
from segmark.llm.textblocks import block_of, blocks
from tests.llm.cases import edge_docs, edge_texts, empty_docs

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = BLANK.findall(text)

    def covered(n):
        at = {}
        for i in range(len(w) - n + 1):
            at.setdefault(tuple(w[i:i + n]), []).append(i)
        return {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + n)}

    seen, n_dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if BLANK.search(line):
            if line in seen:
                n_dup += 1
                dup_chars += sum(map(len, BLANK.findall(line)))
            seen.add(line)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_dup_lines": n_dup, "n_repeat_words": len(covered(3)), "dup_line_chars": dup_chars}
    return out | {f"dup_{n}_chars": sum(len(w[j]) for j in covered(n)) for n in MAX_WINDOW_PCT}


def check(texts):
    m = measure(block_of(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in m.items()} == brute(t), repr(t)[:80]


def test_counts_equal_brute_force_on_edge_texts():
    check(edge_texts())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té#", max_size=120)), min_size=1, max_size=6))
def test_counts_equal_brute_force(texts):
    check(texts)


def test_blocks_cut_between_whole_rows():
    rng = random.Random(1)
    texts = ["x" * rng.randint(0, 50) for _ in range(200)] + [None, "y" * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    seen = []
    for part, block in blocks([batch], "text", 100):
        assert len(block.data) <= 100 or len(block) == 1
        seen += [block.data[a:b].tobytes().decode() for a, b in zip(block.off[:-1], block.off[1:], strict=True)]
        assert part.num_rows == len(block)
    assert seen == [t or "" for t in texts]


def test_edge_rows_and_clashing_columns(spark):
    df = edge_docs(spark).withColumnRenamed("source", "KEPT").withColumnRenamed("n_chars", "n_words")
    got = repetition(df).collect()
    assert len(got) == df.count() and "KEPT" not in got[0].asDict()
    for r in got:
        b = brute(r["text"])
        assert {k: r[k] for k in b} == b
        failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    assert repetition(empty_docs(spark)).count() == 0


def test_clean_text_is_kept_and_looping_text_is_not(spark):
    from tests.llm.cases import docs, sentence

    rng = random.Random(2)
    clean = " ".join(f"{sentence(rng, 1)}{i}" for i in range(120))
    loop = sentence(rng, 12) + " "
    rows = {r.doc_id: r for r in repetition(docs(spark, [clean, loop * 20])).collect()}
    assert rows[0].kept and not rows[1].kept
