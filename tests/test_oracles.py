"""Every registered query against its independent DuckDB oracle (values and types) on sf0.001."""

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck, duck_types, spark_types
from conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLES[name])
    ok, msg = compare(sdf.toPandas(), rel.df())
    assert ok, msg
    assert spark_types(sdf.schema) == duck_types(rel)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.count()
    assert rows > 0 and len(set(df.columns)) == len(df.columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["sample", "strand_mode", "gene_id", "count"]
