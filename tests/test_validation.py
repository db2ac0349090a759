"""Validation operators against the published validation rows."""

import pytest
from pyspark.sql import functions as F

from seqscore.operators import validation

# FIXED VALUES: the published ten-candidate validation run
# (id, proxy_score, e_initial, e_final, delta_e, rank_proxy, rank_physics).
GOLDEN = [
    ("seq_39", 3.390743541799762, 462.94, -3748.61, -4211.55, 1, 4),
    ("seq_7", 1.8029380803942407, 228.8, -4199.07, -4427.87, 2, 2),
    ("seq_32", 1.6614628588837808, 3930.1, -2519.75, -6449.86, 3, 6),
    ("seq_27", 1.4234161315245737, 1489.44, -2139.37, -3628.81, 4, 9),
    ("seq_16", 1.2154469054229584, 1235.37, -2472.62, -3707.98, 5, 7),
    ("seq_48", 1.1282129590174623, 777.67, -2623.16, -3400.82, 6, 5),
    ("seq_20", 1.1171037537722648, 1018.01, -2472.3, -3490.31, 7, 8),
    ("seq_25", 0.7761323475433319, 601.46, -3916.34, -4517.8, 8, 3),
    ("seq_0", 0.7622630788371767, -319.2, -4590.83, -4271.63, 9, 1),
    ("seq_37", 0.7374415646965624, 2438.71, -1668.43, -4107.14, 10, 10),
]


def candidates(spark, rows):
    data = [(i, r[0], r[1], 0.8, 30.0, 0.5, 0.1, r[2], r[3]) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "seq_idx long, id string, score double, plddt double, dist_nc double, muH double, "
              "net_charge double, e_initial double, e_final double")


def test_golden_ranks_and_delta(spark):
    v = validation.rank_validation(validation.energy_rows(candidates(spark, GOLDEN)))
    got = {r.id: r for r in v.collect()}
    for gid, _s, _e0, _e1, de, rp, rf in GOLDEN:
        assert got[gid].delta_e == pytest.approx(de, abs=0.01)
        assert (got[gid].rank_proxy, got[gid].rank_physics) == (rp, rf)
        assert got[gid].converged


def test_golden_summary(spark):
    v = validation.rank_validation(validation.energy_rows(candidates(spark, GOLDEN)))
    s = validation.validation_summary(v).collect()[0]
    assert (s.n_validated, s.n_total) == (10, 10)
    assert s.spearman_rho == 0.1636 and s.spearman_pval == 0.6515
    assert s.interpretation.startswith("Weak positive trend")
    assert (s.best_proxy, s.best_physics) == ("seq_39", "seq_0")
    assert s.mean_delta_e == -4221.38


def test_fewer_than_three_valid(spark):
    rows = [GOLDEN[0], GOLDEN[1][:3] + (None,) + GOLDEN[1][4:], GOLDEN[2]]
    rows = [GOLDEN[0], ("seq_7", 1.8, None, None, None, 0, 0), ("seq_32", 1.6, 1.0, 2.0, 1.0, 0, 0)]
    v = validation.rank_validation(validation.energy_rows(candidates(spark, rows)))
    got = {r.id: r for r in v.collect()}
    assert [got[k].rank_proxy for k in ("seq_39", "seq_7", "seq_32")] == [1, 2, 3]
    assert all(r.rank_physics is None for r in got.values())
    assert not got["seq_7"].converged
    s = validation.validation_summary(v).collect()[0]
    assert (s.spearman_rho, s.spearman_pval, s.interpretation) == (0.0, 1.0, "Insufficient data")


@pytest.mark.parametrize("rho,n,p", [(0.1636363636, 10, 0.651477), (0.5, 3, 2 / 3), (0.3, 4, 0.7),
                                     (1.0, 10, 0.0)])
def test_pvalue_series(spark, rho, n, p):
    df = spark.createDataFrame([(rho, n)], "rho double, n int")
    got = df.select(validation.t_test_pvalue(F.col("rho"), F.col("n")).alias("p")).collect()[0].p
    assert got == pytest.approx(p, abs=1e-6)


def test_rmsd_positional(spark):
    a = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0), (1, 2, 1.0, 0.0, 0.0)],
                              "seq_idx long, ord long, x double, y double, z double")
    b = spark.createDataFrame([(1, 1, 0.0, 3.0, 4.0), (1, 2, 1.0, 0.0, 0.0)],
                              "seq_idx long, ord long, x double, y double, z double")
    r = validation.rmsd(a, b).collect()[0]
    assert r.n_atoms == 2 and r.rmsd == pytest.approx(round((25 / 2) ** 0.5, 3))


def test_nan_energy_is_a_failed_run(spark):
    rows = [GOLDEN[0], ("seq_7", 1.8, float("nan"), float("nan"), None, 0, 0), GOLDEN[2], GOLDEN[3]]
    v = validation.rank_validation(validation.energy_rows(candidates(spark, rows)))
    got = {r.id: r for r in v.collect()}
    assert got["seq_7"].e_final is None and got["seq_7"].rank_physics is None
    assert not got["seq_7"].converged
    assert sorted(r.rank_physics for r in got.values() if r.rank_physics) == [1, 2, 3]


def test_empty_candidates(spark):
    v = validation.rank_validation(validation.energy_rows(candidates(spark, [])))
    assert v.count() == 0
    s = validation.validation_summary(v).collect()[0]
    assert (s.n_validated, s.n_total, s.spearman_rho, s.spearman_pval) == (0, 0, 0.0, 1.0)
    assert s.interpretation == "Insufficient data" and s.best_proxy is None and s.mean_delta_e is None


def test_one_pvalue_formula_for_every_n(spark):
    import math
    from seqscore.operators.validation import t_test_pvalue
    df = spark.createDataFrame([(0.1636363636, 10), (0.5, 3), (0.0, 50), (-0.9, 4), (1.0, 9), (0.3, 2),
                                (0.002, 1_000_000), (0.004, 1_000_000), (0.00002, 4_000_000_000)], "rho double, n long")
    got = [r[0] for r in df.select(t_test_pvalue(F.col("rho"), F.col("n"))).collect()]
    assert got[0] == pytest.approx(0.6515, abs=5e-5)
    assert got[1] == pytest.approx(2 / 3, abs=1e-9) and got[2] == pytest.approx(1) and got[3] == pytest.approx(0.1, abs=1e-9)
    assert got[4] == 0.0 and got[5] is None
    for p, rho, n in ((got[6], 0.002, 1e6), (got[7], 0.004, 1e6), (got[8], 2e-5, 4e9)):
        assert p == pytest.approx(math.erfc(rho * math.sqrt(n) / math.sqrt(2)), rel=1e-4)


def test_rmsd_needs_the_same_atoms(spark):
    from seqscore.operators.validation import rmsd
    schema = "seq_idx long, ord long, x double, y double, z double"
    a = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0), (1, 2, 1.0, 0.0, 0.0)], schema)
    b = spark.createDataFrame([(1, 1, 0.0, 3.0, 0.0), (1, 2, 1.0, 0.0, 3.0)], schema)
    assert [tuple(r) for r in rmsd(a, b).collect()] == [(1, 3.0, 2, None)]
    for x, y, error in ((a, b.limit(1), "atoms differ: 1 missing, 0 added"),
                        (a.limit(1), b, "atoms differ: 0 missing, 1 added")):
        other = spark.createDataFrame([(2, 1, 0.0, 0.0, 0.0)], schema)
        got = sorted(tuple(r) for r in rmsd(x.unionByName(other), y.unionByName(other)).collect())
        assert got == [(1, None, None, error), (2, 0.0, 1, None)]
