"""Every SQL form gives its query's rows at the smallest scale."""
import duckdb
import pytest

from segmark.llm.oracle import ORACLE_SQL
from segmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want, key=key) and len(want) > 0


def test_all_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, len(QUERIES) + 1))
