import random

import numpy as np
import pyarrow as pa
import pytest

from segmark.llm import toxicity
from segmark.llm.langid import held_out
from segmark.llm.textblocks import block_of
from segmark.llm.toxicity import FactorizationMachine, fit, score_toxicity, text_cells, train
from tests.llm.cases import DOCS, edge_docs, empty_docs, sentence


def labelled(n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        text = sentence(rng, 25) + (" " + rng.choice(["you moronic", "utter idiots", "such idiot"]) if toxic else "")
        rows.append((i, text, "en", "s", 0))
        if i % 10:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = labelled()
    df = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels + [(None, 1), (3, None), (labels[0][0], labels[0][1])], "doc_id long, toxic int")
    model = fit(df, lab)
    got = score_toxicity(df.withColumn("held_out", held_out("doc_id")), model).collect()
    truth = dict(labels)
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(tested) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    # Labels of held-out rows, ids and languages change no score.
    flipped = spark.createDataFrame([(i, y if not any(r.doc_id == i and r.held_out for r in got) else 1 - y) for i, y in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in score_toxicity(df.selectExpr("doc_id", "text"), fit(df, flipped)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_edges_and_single_class(spark):
    rows, labels = labelled(80)
    df = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    base = fit(df, lab.where("toxic = 0"))
    out = score_toxicity(edge_docs(spark).withColumnRenamed("lang", "SCORE"), base)
    assert out.count() == edge_docs(spark).count() and len({r.score for r in out.collect()}) == 1
    assert {r.score for r in score_toxicity(df, fit(df, lab.limit(0))).collect()} == {0.5}
    assert score_toxicity(empty_docs(spark), base).count() == 0
    assert fit(empty_docs(spark), lab).bias == 0.0


def test_sample_is_bounded_by_its_parameter(spark):
    rows, labels = labelled()
    model = fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"), sample_rows=60)
    assert (model.chosen >= 0).sum() <= toxicity.MAX_CELLS + toxicity.MAX_WORDS


def test_pairs_beyond_single_terms():
    """A label that needs both of two terms is learned by the factors, which linear weights cannot do."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (4000, 6)).astype(np.uint8)
    y = (x[:, 0] ^ x[:, 1]).astype(float)
    bias, w, v = train(x, y, epochs=60)
    model = FactorizationMachine(np.full(toxicity.SPACE, -1), bias, w, v)
    s = x @ v
    z = model.bias + x @ w + 0.5 * (s**2 - x @ (v * v)).sum(axis=1)
    assert np.mean((z > 0) == (y > 0)) > 0.9


@pytest.mark.parametrize("kind", ["either", "both"])
def test_pairs_through_the_whole_operator(spark, kind):
    """Either of two words but not both; or an insult beside a mention of a group: neither counts alone."""
    rng = random.Random(6)
    insults, groups = ["zorp", "zorpish", "quolm"], ["vexians", "uldites"]
    rows, labels = [], []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = sentence(rng, 25).split()
        for present, choice in ((a, insults[:1] if kind == "either" else insults), (b, groups[:1] if kind == "either" else groups)):
            if present:
                words.insert(rng.randrange(25), rng.choice(choice))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(a != b if kind == "either" else a and b)))
    df = spark.createDataFrame(rows, DOCS)
    model = fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = score_toxicity(df.withColumn("held_out", held_out("doc_id")), model).where("held_out").collect()
    truth = dict(labels)
    assert len(got) > 600 and np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95


def test_scores_equal_the_definition():
    rng = np.random.default_rng(2)
    texts = ["idiot moron idiots", "a bc def", "", "ünï idiot!"]
    block = block_of(pa.array(texts))
    doc, cell = text_cells(block)
    used = np.unique(cell)
    chosen = np.full(toxicity.SPACE, -1)
    chosen[used] = np.arange(len(used))
    w, v = rng.normal(size=len(used)), rng.normal(size=(len(used), 3))
    got = FactorizationMachine(chosen, 0.3, w, v).scores(block)
    for d in range(len(texts)):
        c = chosen[cell[doc == d]]
        z = 0.3 + w[c].sum() + sum(v[i] @ v[j] for a, i in enumerate(c) for j in c[a + 1:])
        assert abs(got[d] - 1 / (1 + np.exp(-z))) < 1e-9
