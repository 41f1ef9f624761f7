"""Every deterministic query against DuckDB; fitted ones must give rows."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from farol import oracles
from farol import queries as q

QUERIES, ORACLE = {f.__name__: f for f in q.QUERIES}, oracles.all_sql()


@pytest.fixture(scope="module")
def duck(base):
    return connect(base)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_duckdb(spark, base, duck, name):
    assert difference(QUERIES[name](spark, base), duck, ORACLE[name]) is None


def test_entry_lists_every_query_and_statement():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLE.keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["uf", "n", "taxa", "cobertura_historico", "taxa_prior"]
    assert out.count() > 0
