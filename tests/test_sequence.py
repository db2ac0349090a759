"""Sequence expressions and descriptors."""

import pytest
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.functions import sequence as S
from seqscore.operators.descriptors import descriptors, dipeptide_counts, instability_index


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("v")).collect()[0].v


def test_normalize_strips_all_whitespace(spark):
    assert one(spark, " \t acdk\n", S.normalize_sequence) == "ACDK"


@pytest.mark.parametrize("raw,exp", [("seq_12", 12), ("seq_x", None), ("foo", None), ("seq_3_b", None)])
def test_parse_id(spark, raw, exp):
    assert one(spark, raw, S.parse_id) == exp


def test_cys_count_case_sensitive(spark):
    assert one(spark, "CCcAC", S.cys_count) == 3


@pytest.mark.parametrize("raw,exp", [("MKV\n", "KV"), ("M", "M"), ("AMK", "AMK"), ("M\nM", "M")])
def test_clean_generated(spark, raw, exp):
    assert one(spark, raw, S.clean_generated) == exp


def test_hydrophobicity(spark):
    assert one(spark, "AR", S.hydrophobicity) == pytest.approx((1.8 - 4.5) / 2)
    assert one(spark, "", S.hydrophobicity) is None


def py_charge(seq, ph, pka):
    z = 1 / (1 + 10 ** (ph - pka["Nterm"])) - 1 / (1 + 10 ** (pka["Cterm"] - ph))
    for aa in "HKR":
        z += seq.count(aa) / (1 + 10 ** (ph - pka[aa]))
    for aa in "CDEY":
        z -= seq.count(aa) / (1 + 10 ** (pka[aa] - ph))
    return z


def test_charge_matches_formula(spark):
    seq = "KKRHDECYAAGW"
    assert one(spark, seq, lambda c: S.charge(c, 7.4)) == pytest.approx(py_charge(seq, 7.4, C.PKA_LEHNINGER))


def test_isoelectric_point_zero_charge(spark):
    df = spark.createDataFrame([("KKRHDECYAAGW",), ("DDDEEA",), ("KKKRRA",), ("G",)], "sequence string")
    for r in S.isoelectric_point(df).collect():
        assert abs(py_charge(r.sequence, r.isoelectric_point, C.PKA_EMBOSS)) < 1e-6


def test_dipeptides_overlap(spark):
    got = one(spark, "ABCDE", S.dipeptides)
    assert sorted(got) == ["AB", "BC", "CD", "DE"]


def test_instability_with_supplied_weights(spark):
    seqs = spark.createDataFrame([(1, "ACDA"), (2, "A"), (3, "")], "seq_idx long, sequence string")
    w = spark.createDataFrame([("AC", 10.0), ("CD", -4.0)], "dipeptide string, weight double")
    got = {r.seq_idx: r.instability_index for r in instability_index(seqs, w).collect()}
    assert got[1] == pytest.approx(10 / 4 * (10.0 - 4.0 + 0.0))
    assert got[2] == 0.0 and got[3] is None


def test_no_table_no_index(spark):
    seqs = spark.createDataFrame([(1, "ACDK"), (2, "")], "seq_idx long, sequence string")
    assert [r.instability_index for r in instability_index(seqs).collect()] == [None, None]
    assert [r.instability_index for r in descriptors(seqs).collect()] == [None, None]


def test_dipeptide_counts(spark):
    seqs = spark.createDataFrame([(1, "ACDEFGHIKL" * 3), (2, "MNPQRSTVWY" * 2)], "seq_idx long, sequence string")
    c = dipeptide_counts(seqs)
    assert c.groupBy().sum("n").collect()[0][0] == 29 + 19


def test_half_even_rounding(spark):
    from seqscore.functions.numeric import round_dp
    vals = [0.125, -0.125, 0.625, 0.375, 2.675, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(round_dp("v", 2)).collect()] == [0.12, -0.12, 0.62, 0.38, 2.68, None]


def test_descriptors_keep_columns_and_limit(spark):
    seqs = spark.createDataFrame([(0, "x", "ACDK"), (1, "y", "KKR"), (2, "z", "DE")],
                                 "seq_idx long, tag string, sequence string")
    d = descriptors(seqs, limit=2)
    assert set(d.columns) >= {"seq_idx", "tag", "sequence", "hydrophobicity", "charge",
                              "instability_index", "isoelectric_point"}
    assert sorted(r.seq_idx for r in d.collect()) == [0, 1]


def test_instability_paths_agree(spark):
    from seqscore.operators.descriptors import instability_index_native
    import random
    from seqscore.sources.fixtures import synthetic_weights
    w = synthetic_weights(spark)
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice(C.AMINO_ACIDS) for _ in range(rnd.randint(0, 60)))) for i in range(40)]
    seqs = spark.createDataFrame(rows, "seq_idx long, sequence string")
    a = {r.seq_idx: r.instability_index for r in instability_index(seqs, w).collect()}
    b = {r.seq_idx: r.instability_index for r in instability_index_native(seqs, w).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], abs=1e-12)
