import random
import re

import corpus_pipeline
from tests.llm.cases import DOCS
from tests.llm.test_langid import SPOKEN, corpus
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_simhash import brute_components, brute_print


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def make_tables(spark, path):
    rng = random.Random(12)
    rows = corpus(60)
    words = [r[1] for r in rows]
    item = " ".join(rng.choice(SPOKEN["aa"]) + rng.choice(SPOKEN["aa"])[:3] for _ in range(30))
    rows += [(60, words[3], "aa", "s", 0), (61, words[4] + " tail", "aa", "s", 0), (62, None, None, None, None), (63, "", None, "s", 0), (64, "12 34", None, "s", 0)]
    rows += [(65, item, "aa", "s", 0), (None, words[7] + " without id", "bb", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return item


def test_stages_match_brute_force(spark, tmp_path):
    from segmark.llm.common import handover, table

    item = make_tables(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    step = lambda name, d: handover(stages[name](spark, d, str(tmp_path)), "test-stage")
    known = step("language_id", docs)
    assert known.columns == columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in known.collect()}
    assert {i for i in before if i not in after} >= {62, 63, 64} and set(range(60)) <= set(after)
    assert all(after[i] == before[i] for i in after)

    lines = step("line_dedup", known)
    rows = sorted(known.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    want, _ = brute_lines([r.text for r in rows])
    got = {r.doc_id: r.text for r in lines.collect()}
    wrong = [r.doc_id for r, t in zip(rows, want, strict=True) if got[r.doc_id] != t]
    assert lines.columns == columns and len(wrong) <= 2 and got[60] == ""

    near = step("near_dedup", lines)
    rows = lines.collect()
    owner = brute_components([r.doc_id for r in rows], [brute_print(r.text) for r in rows])
    assert near.columns == columns
    assert {r.doc_id for r in near.collect()} == set(owner) and near.count() == len(set(owner))

    clean = step("decontamination", near)
    grams = {tuple(word_list(item)[i:i + 13]) for i in range(len(word_list(item)) - 12)}
    bad = {r.doc_id for r in near.collect() if any(tuple(word_list(r.text)[i:i + 13]) in grams for i in range(len(word_list(r.text))))}
    assert bad and {r.doc_id for r in near.collect()} - {r.doc_id for r in clean.collect()} == bad and clean.columns == columns

    packed = step("packing", clean)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()


def test_empty_documents(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
