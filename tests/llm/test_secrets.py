import hashlib
import re

from segmark.llm.secrets import RULES, SecretRule, addressed, findings, scan_secrets, update_ledger
from segmark.session import scratch_path
from tests.llm.cases import DOCS, edge_docs, empty_docs

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
TEXTS = [
    None, "", "token = abcdef", "token=abcde", 'PassWord": "hunter22" and api_key:\x20\x20x1y2z3w4', "token=token=abcdefgh secret:'a.b-c/d'",
    "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "xAKIAAKIA" + "Z" * 16, "deadbeef" * 3, "deadbeef" * 2, "é🙂 token = " + "0123456789abcdef" * 2,
    "secret = \n nothing", "-----BEGIN RSA PRIVATE KEY----- token: zzzzzz", "ghp_" + "a1B2" * 9, "passwd=abc token=abcdefg" * 40,
    "tſoken=abcdef tOKEN=abcdef Key", "api-key=abcdefg apikey=abcdefg API_KEY = 'q1w2e3r4'",
]


def brute(text):
    spans = []
    for rank, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        spans += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(spans)


def test_base_spans_equal_brute_force(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], None, None, None), (2, TEXTS[2], None, None, None)]
    got = scan_secrets(spark.createDataFrame(rows, DOCS), scratch_path(spark, "ledger")).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = brute(r.text)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[2] == k for s in spans) for k in BASE), r.text
        base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), r.text
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))
    kinds = {s.split(":")[0] for r in got for s in r.spans.split(",") if s}
    assert {"pem", "forge"} <= kinds


def test_only_unseen_pairs_are_scanned(spark):
    path = scratch_path(spark, "ledger")
    docs = addressed(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))
    first = update_ledger(spark, docs, path)
    n = len(set(t or "" for t in TEXTS)) * len(RULES)
    assert first.count() == n
    assert update_ledger(spark, docs, path).count() == n  # nothing new
    assert update_ledger(spark, docs.limit(0), path).count() == n
    changed = (*RULES[:-1], SecretRule("jwt", "2", r"jwt[0-9]+", 0, 4))
    again = update_ledger(spark, docs, path, changed)
    assert again.count() == n + n // len(RULES)
    more = addressed(spark.createDataFrame([(99, "a new secret: jwt12345")], "doc_id long, text string"))
    assert update_ledger(spark, more, path, changed).count() == n + n // len(RULES) + len(RULES)
    assert again.groupBy("blob", "rule", "rule_version").count().where("count > 1").count() == 0
    assert "jwt:" in findings(update_ledger(spark, more, path, changed), changed).where("spans like '%jwt%'").first().spans


def test_edge_tables_and_native_plan(spark):
    assert scan_secrets(empty_docs(spark), scratch_path(spark, "ledger")).count() == 0
    df = edge_docs(spark).withColumnRenamed("lang", "SPANS")
    out = scan_secrets(df, scratch_path(spark, "ledger"))
    assert out.count() == df.count() and out.columns.count("spans") == 1 and "SPANS" not in out.columns
    assert "Python" not in out._jdf.queryExecution().toString()


def test_clashing_columns_and_a_pair_scanned_twice(spark, tmp_path):
    from segmark.llm.secrets import scan_secrets

    df = spark.createDataFrame([(1, "password = hunter2222", "b", "s"), (2, "none", "b", "s")], "doc_id long, text string, base_spans string, SPANS string")
    path = str(tmp_path / "ledger")
    first = sorted(map(str, scan_secrets(df, path).collect()))
    ledger = spark.read.parquet(path).collect()
    spark.createDataFrame(ledger, spark.read.parquet(path).schema).write.mode("append").parquet(path)
    again = scan_secrets(df, path)
    assert sorted(map(str, again.collect())) == first and "base_spans" not in again.columns
    assert [r.n_assign for r in again.orderBy("doc_id").collect()] == [1, 0]
