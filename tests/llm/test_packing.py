import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from segmark.llm.packing import Capacity, TextEncoder, best_fit, pack, pack_documents, token_pieces  # noqa: E402
from segmark.llm.textblocks import block_of  # noqa: E402
from tests.llm.cases import edge_docs, edge_texts, empty_docs, sentence  # noqa: E402

TOUGH = ["Hello <|endoftext|> wor<|startoftext|>ld it's İstanbul ΑΣ ΣΑΣ x\x0by\x1cz  é 12 34 \U0001f642\U0001f642 \r\n don't", "<|EndOfText|> <|endoftext|><|endoftext|>",
         "École ÉÀÿß œuvre µm naïve Å ñandú straße ÷ Éé.à ªº café a1b22c a.b.c ...x... x'll'S 'tis don't. $a1$ Å", "日本語テキスト русский текст ελληνικά", "﻿bom  nbsp em"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def reference_ids(vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(vocabulary)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizer(vocabulary, reference_ids):
    import pyarrow as pa

    rng = random.Random(3)
    alphabet = "aB é.,'1<|>-\n\t ßÑ" + "́"
    texts = edge_texts() + TOUGH + ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(150)]
    encoder = TextEncoder(vocabulary, 0)
    for part in (texts, texts[:20], texts[::-1]):
        ids, off = encoder.ids(block_of(pa.array(part, pa.string())))
        for i, t in enumerate(part):
            assert ids[off[i]:off[i + 1]].tolist() == reference_ids(t), repr(t)[:80]


def test_every_piece_once_in_gapless_sequences(spark, vocabulary, reference_ids):
    rng = random.Random(4)
    df = edge_docs(spark).union(spark.createDataFrame([(100 + i, sentence(rng, rng.randint(1, 900)), "en", "s", 0) for i in range(120)], edge_docs(spark).schema))
    rows = df.collect()
    got = pack_documents(df, vocabulary, with_ids=True).collect()
    want = []
    for r in rows:
        ids = reference_ids(r.text)
        for p, start in enumerate(range(0, len(ids), 2048)):
            piece = ids[start:start + 2048]
            want.append((r.doc_id is None, r.doc_id or 0, p, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), tuple(piece)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == sorted(want)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(w[4] for w in want)
    assert len(by_sequence) <= 1.05 * -(-total // 2048) + 1
    assert pack_documents(empty_docs(spark), vocabulary).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_capacity(rule):
    rng = np.random.default_rng(5)
    length = np.minimum(2047, rng.exponential(400, 1500).astype(int) + 1)
    cap = Capacity(documents=4, attention=2048 * 2048, rule=rule, weights=(1.0, 0.5, 0.5))
    bins, offset, made = best_fit(length, cap)
    assert len(np.unique(bins)) == made
    for b in range(made):
        own = bins == b
        assert own.sum() <= 4 and length[own].sum() <= 2048 and (length[own] ** 2).sum() <= cap.attention
        order = np.argsort(offset[own])
        assert (offset[own][order] == np.concatenate(([0], np.cumsum(length[own][order])[:-1]))).all()
    free, _, least = best_fit(length, Capacity(rule=rule))
    assert least <= 1.02 * -(-length.sum() // 2048) + 1 and len(free) == len(length)


def test_groups_of_any_size_and_bad_settings(spark, vocabulary):
    df = edge_docs(spark)
    pieces = token_pieces(df, vocabulary)
    small, big = pack(pieces, group_pieces=3).collect(), pack(pieces).collect()
    assert sorted((r.length, r.ids_crc32) for r in small) == sorted((r.length, r.ids_crc32) for r in big)
    for kwargs in ({"rule": "first"}, {"tokens": 0}, {"attention": 100}):
        with pytest.raises(ValueError):
            Capacity(**kwargs)


def test_operator_with_a_document_limit_that_binds(spark, vocabulary):
    rng = random.Random(6)
    df = spark.createDataFrame([(i, sentence(rng, rng.randint(1, 60)), "en", "s", 0) for i in range(160)], edge_docs(spark).schema)

    def sequences(cap):
        out = {}
        for r in pack_documents(df, vocabulary, cap=cap).collect():
            out.setdefault(r.sequence_id, []).append(r.length)
        return list(out.values())

    free, bound = sequences(Capacity()), sequences(Capacity(documents=4))
    assert max(map(len, free)) > 4 and sorted(map(len, bound)) == [4] * 40
    assert sum(map(sum, bound)) == sum(map(sum, free)) and max(map(sum, bound)) <= 2048
    # The attention limit is at least the square of the token limit, so it cannot bind.
    with pytest.raises(ValueError):
        Capacity(attention=2048 * 2048 - 1)
