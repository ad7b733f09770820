"""Every catalog query with a SQL oracle equals DuckDB's answer at sf0.001."""
from __future__ import annotations

import os
import sys

import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from segmark.plans.catalog import QUERIES  # noqa: E402

SF_MEDIUM = os.path.join(os.path.dirname(SF_SMALL), "sf0.01")
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], SQL[name], SF_SMALL)
    assert r["status"] in ("OK", "OK~"), r


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries())


def test_the_tables_reach_every_branch(spark, con):
    """All reachable rule and profile labels, and missing keys, occur in the given tables."""
    got = {r.segment_label for r in QUERIES["rule_segment_distribution"](spark, SF_MEDIUM).collect()}
    assert got == {"Recurrente alto", "Recurrente", "Metropolitano", "Estándar regional"}
    got = {r.segment_label for r in QUERIES["label_by_profile_mixed"](spark, SF_MEDIUM).select("segment_label").distinct().collect()}
    assert got == {"Recurrente", "Itinerante", "Metropolitano", "Estándar regional"}
    assert QUERIES["not_null_keys"](spark, SF_MEDIUM).count() < spark.read.parquet(f"{SF_MEDIUM}/orders.parquet").count()
    sources = {r[0] for r in QUERIES["marts_from_retrain"](spark, SF_SMALL).select("segment_source").distinct().collect()}
    assert sources == {"kmeans", "rule_based"}


@pytest.mark.parametrize("name", ["dq_not_null", "dq_unique", "dq_unique_orders", "dq_marts", "dq_relationships", "dq_accepted_values",
                                  "dq_coverage", "dq_bounds"])
def test_checks_find_something(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    assert rows and (name != "dq_not_null" or sum(r.violations > 0 for r in rows) >= 4)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment_label", "customers"]
    assert df.count() >= 1
