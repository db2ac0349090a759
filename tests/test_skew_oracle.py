"""A third of all line items moved into one structure: centroids and ordinals
against the oracle SQL run on the same skewed table."""

import os
import tempfile

import pyarrow.parquet as pq
import pytest

from seqscore.operators import structure, validation
from seqscore.operators.ranking import ordinal_within
from seqscore.plans.check import canonical
from seqscore.plans.oracle import QUERIES as SQL
from seqscore.sources import fixtures

SRC = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed_dir():
    import duckdb
    d = tempfile.mkdtemp(prefix="seqscore-skew-")
    li = pq.read_table(os.path.join(SRC, "lineitem.parquet")).to_pandas()
    hot = li.index % 3 == 0
    li.loc[hot, "l_orderkey"] = 0
    # the file-order key must stay unique inside the hot structure
    li = li.drop_duplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    li.to_parquet(os.path.join(d, "lineitem.parquet"), index=False)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{d}/lineitem.parquet')")
    assert con.execute("SELECT count(*) FILTER (WHERE l_orderkey = 0) * 3 >= count(*) - 3 FROM lineitem").fetchone()[0]
    return d, con


def rows(df, cols):
    return canonical([tuple(r[c] for c in cols) for r in df.collect()])


def test_structure_metrics_hot_path(spark, skewed_dir):
    d, con = skewed_dir
    atoms = fixtures.ca_atoms(spark, d)
    m = structure.structure_metrics(atoms, ["seq_idx"], "ord_key")
    m = structure.rounded(m, ["net_charge", "muH", "plddt", "dist_nc"])
    m = m.select(fixtures.structure_id().alias("id"), "n_res", "net_charge", "muH", "plddt", "dist_nc")
    cols = sorted(m.columns)
    rel = con.execute(SQL["structure_metrics"])
    names = [x[0] for x in rel.description]
    exp = canonical([tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()])
    assert rows(m, cols) == exp


def test_ordinal_and_rmsd_hot_path(spark, skewed_dir):
    d, con = skewed_dir
    before = ordinal_within(fixtures.ca_atoms(spark, d), ["seq_idx"], ["ord_key"], "ord",
                            num_partitions=6)
    after = fixtures.relaxed_atoms(before)
    got = validation.rmsd(before, after).select(fixtures.structure_id().alias("id"), "rmsd", "n_atoms")
    cols = sorted(got.columns)
    rel = con.execute(SQL["rmsd"])
    names = [x[0] for x in rel.description]
    exp = canonical([tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()])
    assert rows(got, cols) == exp


def test_nearest_join_hot_user(spark):
    """A third of all events belong to one user; the registered query (range
    partitions + carried edge rows) against its brute-force SQL."""
    import duckdb
    from seqscore.plans.catalog import QUERIES
    d = tempfile.mkdtemp(prefix="seqscore-skew-ev-")
    ev = pq.read_table(os.path.join(SRC, "events.parquet")).to_pandas()
    ev.loc[ev.index % 3 == 0, "user_id"] = 0
    ev.to_parquet(os.path.join(d, "events.parquet"), index=False)
    got = QUERIES["nearest_join"](spark, d)
    cols = sorted(got.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{d}/events.parquet')")
    rel = con.execute(SQL["nearest_join"])
    names = [x[0] for x in rel.description]
    exp = canonical([tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()])
    assert rows(got, cols) == exp
