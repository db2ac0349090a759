"""Every registered query against its DuckDB SQL on the smallest data set,
plus the driver contract."""

import pytest

from seqscore.plans.catalog import QUERIES
from seqscore.plans.check import compare, duck_views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_views(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, con)
    assert r.get("oracle", True) is None or r["match"], r


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())


def test_register_views_for_sql(spark):
    from seqscore.plans.catalog import register_views
    names = register_views(spark, SF)
    assert names == ["ca_atoms", "energies", "peptides", "ranked", "scores"]
    r = spark.sql("SELECT count(*) AS n, max(rank) AS m FROM ranked").collect()[0]
    assert r.n == r.m == spark.sql("SELECT count(DISTINCT seq_idx) FROM ca_atoms").collect()[0][0]
