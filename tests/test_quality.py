"""Data-quality checks return exactly the planted violations."""
from __future__ import annotations

import datetime as dt

from segmark.operators import quality as q


def test_not_null_and_summary(spark):
    df = spark.createDataFrame([("a", None), (None, "x"), ("c", "y")], "k string, v string")
    got = {(r.column_name, r.violations) for r in q.not_null_summary(df, "t", ["k", "v"]).collect()}
    assert got == {("k", 1), ("v", 1)}


def test_unique_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    rows = q.unique_violations(df, ["a", "b"]).collect()
    assert [(r.a, r.b, r.occurrences) for r in rows] == [(1, 1, 2)]


def test_relationships_ignore_null_keys(spark):
    child = spark.createDataFrame([("SP",), ("XX",), (None,)], "s string")
    parent = spark.createDataFrame([("SP",)], "code string")
    assert [r.s for r in q.relationship_violations(child, "s", parent, "code").collect()] == ["XX"]


def test_accepted_values(spark):
    df = spark.createDataFrame([("A",), ("B",), ("Z",), ("Z",), (None,)], "l string")
    rows = q.accepted_values_violations(df, "l", ["A", "B"]).collect()
    assert [(r.l, r.occurrences, r.severity) for r in rows] == [("Z", 2, "warn")]


def test_coverage(spark):
    dim = spark.createDataFrame([("a",), ("b",)], "customer_unique_id string")
    fct = spark.createDataFrame([("a",)], "customer_unique_id string")
    assert [r.customer_unique_id for r in q.coverage_violations(dim, fct).collect()] == ["b"]


def test_freshness_levels(spark):
    newest = dt.datetime(2024, 1, 30, 12, 0)
    df = spark.createDataFrame([(newest,), (dt.datetime(2024, 1, 1),)], "ts timestamp")
    as_of = [newest + dt.timedelta(hours=h) for h in (1, 40, 80)]
    got = [(r.age_hours, r.status) for r in q.freshness(df, "ts", as_of).collect()]
    assert got == [(1.0, "pass"), (40.0, "warn"), (80.0, "error")]


def test_bounds_grain_length(spark):
    df = spark.createDataFrame([("a", 0.5, "SP"), ("a", 1.5, "mg "), ("b", None, "RJ")], "k string, s double, st string")
    assert q.bounds_violations(df, "s", 0.0, 1.0).count() == 2
    g = q.grain_check(df, "k").collect()[0]
    assert (g.rows, g.distinct_keys, g.duplicates) == (3, 2, 1)
    assert [r.st for r in q.length_violations(df, "st", 2).collect()] == ["mg "]


def test_reconcile(spark):
    df = spark.createDataFrame(
        [("a", 3, 1, "X"), ("b", 1, 0, "Y"), ("c", 1, 0, "Y")],
        "customer_unique_id string, num_orders long, is_repeat_customer int, segment_label string",
    )
    r = q.reconcile_counts(df).collect()[0]
    assert (r.orders, r.persons, r.repeat_customers, r.segments) == (5, 3, 1, 2)


def test_mart_checks(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), (None, "y"), (None, "y"), ("c", "z")], "p string, label string")
    bad = {r.p: (r.occurrences, r.missing_labels) for r in q.mart_violations(df, "t", "p", "label").collect()}
    assert bad == {"a": (2, 0), "b": (1, 1), None: (2, 0)}
    assert tuple(q.mart_summary(df, "t", "p", "label").first()) == ("t", 3, 1, 2, 1)
    assert tuple(q.mart_summary(df.limit(0), "t", "p", "none").first()) == ("t", 0, 0, 0, 0)
