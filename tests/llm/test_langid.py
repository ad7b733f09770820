import random
import zlib

import numpy as np
import pyarrow as pa

from segmark.llm.langid import END, START, UNKNOWN, _text_score, build_models, drop_rejected, fit, gram_counts, identify, identify_languages, letters
from segmark.llm.textblocks import block_of
from tests.llm.cases import DOCS, edge_docs, empty_docs

SPOKEN = {"aa": ["lorem", "ipsum", "dolor", "amet", "rosa", "sole"], "bb": ["krgh", "zwet", "wrtz", "pfek", "schk", "ghtw"], "cc": ["ñaóé", "ííla", "óñol", "éáma"]}


def corpus(n=240, seed=6):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SPOKEN))
        text = " ".join(rng.choice(SPOKEN[lang]) + rng.choice(SPOKEN[lang])[:3] for _ in range(rng.randint(4, 60)))
        rows.append((i, text, lang, "s", 0))
    return rows


def brute_counts(words, order=4):
    out = {}
    for w in words:
        s = START + w + END
        for i in range(1, len(s)):
            g = s[max(0, i - order + 1):i + 1]
            out[g] = out.get(g, 0) + 1
    return out


def brute_logp(counts, word, order=4):
    """Interpolated Kneser-Ney by its recursive definition."""
    level = {k: {} for k in range(1, order + 1)}
    for g, n in counts.items():
        level[len(g)][g] = level[len(g)].get(g, 0) + n
    for k in range(order - 1, 0, -1):
        for g in level[k + 1]:
            level[k][g[1:]] = level[k].get(g[1:], 0) + 1
    symbols = len(level[1])

    def discount(k):
        once, twice = (sum(v == x for v in level[k].values()) for x in (1, 2))
        return min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (symbols + 1)
        followers = [n for h, n in level[k].items() if h[:-1] == g[:-1]]
        if not followers:
            return p(g[1:])
        d, total = discount(k), sum(followers)
        return max(level[k].get(g, 0) - d, 0) / total + d * len(followers) / total * p(g[1:])

    s = START + word + END
    return sum(np.log(p(s[max(0, i - order + 1):i + 1])) for i in range(1, len(s)))


def test_word_scores_equal_the_recursive_definition():
    rng = random.Random(2)
    counts = {k: brute_counts([rng.choice(v) + rng.choice(v)[:2] for _ in range(60)]) for k, v in SPOKEN.items()}
    models = build_models(counts)
    asked = ["lorem", "solero", "zwetgh", "ñaóéíí", "q", "zzzz", "lore", "x" * 30]
    value, n = models.word_scores(asked)
    for i, w in enumerate(asked):
        assert n[i] == len(w) + 1
        for j, lang in enumerate(models.langs):
            assert abs(value[i, j] - brute_logp(counts[lang], w)) < 1e-9


def test_held_out_accuracy_and_edges(spark):
    df = spark.createDataFrame(corpus(), DOCS)
    got = identify_languages(df.withColumnRenamed("source", "Score")).collect()
    assert len(got) == df.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    tested = [r for r in got if r.held_out]
    assert len(tested) > 20 and all(r.lang_pred == r.lang and not r.rejected for r in tested)
    edge = identify_languages(df.unionByName(edge_docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars"))).collect()
    for r in edge:
        has = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == UNKNOWN) == (not has) and (has or (r.score == 0 and r.rejected))


def test_prediction_ignores_ids_labels_and_sources(spark):
    df = spark.createDataFrame(corpus(120), DOCS)
    models = fit(df)
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(df, models).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in identify(df.selectExpr("doc_id", "text", "'zz' as lang", "'q' as source"), models).collect()}
    assert a == b


def test_rejection_keeps_language_and_drops_noise(spark):
    rng = random.Random(3)
    noise = [(500 + i, "".join(rng.choice("qxjvkzw") for _ in range(400)), None, "s", 0) for i in range(5)]
    blank = [(600, None, None, "s", 0), (601, "1234 %%", None, "s", 0)]
    df = spark.createDataFrame(corpus(300) + noise + blank, DOCS)
    kept = drop_rejected(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == set(range(300))


def test_small_models_keep_the_frequent_grams(spark):
    df = spark.createDataFrame(corpus(150), DOCS)
    small = fit(df, max_grams=90)
    assert 0 < sum(len(k) for k in small.keys[3:]) <= 90
    assert identify(empty_docs(spark), small).count() == 0
    none = fit(empty_docs(spark))
    assert {(r.lang_pred, r.score) for r in identify(df, none).collect()} == {(UNKNOWN, 0.0)}


def test_letters_leave_codes_out():
    text, mixed = letters([b"ab", "éa·b".encode(), b"a1b2", b"12", "naïve".encode(), "́".encode()])
    assert text == ["ab", "éab", "ab", "", "naïve", ""] and mixed.tolist() == [False, False, True, True, False, False]
    models = build_models({"x": brute_counts(["abc", "abd"])})
    r = models.classify(block_of(pa.array(["a1b2 c3", "12 34", "abc a1", None])))
    assert r["best"].tolist() == [0, -1, 0, -1]


def test_statistics_and_limits_come_from_all_counts(spark):
    df = spark.createDataFrame(corpus(150), DOCS)
    counts = {}
    for r in gram_counts(df, "lang", "text").collect():
        counts.setdefault(r.lang, {})[r.gram] = r.n
    want, got, small = build_models(counts), fit(df), fit(df, max_grams=90)
    asked = ["lorem", "solero", "zwetgh", "ñaóéíí", "q", "zzzz", "lore"]
    assert got.langs == want.langs and [len(k) for k in got.keys] == [len(k) for k in want.keys]
    assert np.allclose(got.word_scores(asked)[0], want.word_scores(asked)[0], rtol=0, atol=1e-9)
    assert np.allclose(got.limit, want.limit) and np.allclose(got.spread, want.spread)
    # A bounded scorer keeps the probabilities of all counts and is calibrated on all of them.
    assert len(small.keys[3]) < len(want.keys[3])
    for k in range(4):
        at = np.searchsorted(want.keys[k], small.keys[k])
        assert (want.keys[k][at] == small.keys[k]).all()
        for i, j in enumerate(at):
            mine, all_ = ({int(m.logp[k][1][e]): m.logp[k][2][e] for e in range(m.logp[k][0][x], m.logp[k][0][x + 1])} for m, x in ((small, i), (want, j)))
            assert all(abs(v - all_[x]) < 1e-9 for x, v in mine.items())
    scored = np.array([_text_score(small, list(counts[x]), np.array(list(counts[x].values()))) for x in small.langs])
    mean = scored[:, 1] / scored[:, 0]
    own = np.diag(mean)
    nearest = [min(mean[j, i] - own[i] for j in range(len(own)) if j != i) for i in range(len(own))]
    assert np.allclose(small.limit, own + np.maximum(0.5 * np.array(nearest), 0.25))
    assert not np.allclose(small.limit, want.limit)
