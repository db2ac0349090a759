"""Structure metrics and score: edge rows, both forms, skew path."""

import math

import pytest
from pyspark.sql import functions as F

from seqscore.config import ScoringConfig
from seqscore.operators import structure

CFG = ScoringConfig()
SCHEMA = "sid string, ord int, resname string, x double, y double, z double, plddt double"


def metrics(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    m = structure.structure_metrics(df, ["sid"], "ord")
    return {r.sid: r for r in structure.add_score(m, CFG).collect()}


def py_metrics(atoms):
    """Plain-Python statement of the scorer for one structure."""
    from seqscore.constants import EISENBERG
    n = len(atoms)
    cx = sum(a[2] for a in atoms) / n
    cy = sum(a[3] for a in atoms) / n
    cz = sum(a[4] for a in atoms) / n
    sx = sy = sz = 0.0
    charge = 0
    for res, _o, x, y, z, _b in atoms:
        dx, dy, dz = x - cx, y - cy, z - cz
        nrm = math.sqrt(dx * dx + dy * dy + dz * dz) or 1.0
        h = EISENBERG.get(res, 0.0)
        sx, sy, sz = sx + dx / nrm * h, sy + dy / nrm * h, sz + dz / nrm * h
        charge += 1 if res in ("ARG", "LYS") else -1 if res in ("ASP", "GLU") else 0
    first, last = atoms[0], atoms[-1]
    dist = math.dist(first[2:5], last[2:5])
    plddt = sum(a[5] for a in atoms) / n
    mu = math.sqrt(sx * sx + sy * sy + sz * sz) / n
    score = charge / n * 0.25 + mu * 5.0 + plddt - (2.0 if dist > 4.5 else 0.0)
    return charge / n, mu, plddt, dist, score


def test_single_residue(spark):
    m = metrics(spark, [("a", 1, "LYS", 1.0, 2.0, 3.0, 0.9)])["a"]
    assert m.n_res == 1 and m.muH == 0.0 and m.dist_nc == 0.0
    assert m.net_charge == 1.0
    assert m.score == pytest.approx(0.25 + 0.9)
    assert m.cyclic_candidate


def test_unknown_residue_weighs_zero_and_histidine_neutral(spark):
    m = metrics(spark, [("a", 1, "XYZ", 0.0, 0.0, 0.0, 0.5), ("a", 2, "HIS", 1.0, 0.0, 0.0, 0.5)])["a"]
    assert m.net_charge == 0.0
    # only HIS contributes: unit vector (+1,0,0) * -0.40 / 2
    assert m.muH == pytest.approx(0.2)


def test_zero_norm_guard(spark):
    # the middle atom sits exactly on the centroid
    rows = [("a", 1, "ALA", -1.0, 0.0, 0.0, 1.0), ("a", 2, "LEU", 0.0, 0.0, 0.0, 1.0),
            ("a", 3, "ALA", 1.0, 0.0, 0.0, 1.0)]
    m = metrics(spark, rows)["a"]
    assert m.muH == pytest.approx(0.0, abs=1e-12)
    assert m.dist_nc == pytest.approx(2.0)


def test_threshold_equality_neither_penalty_nor_candidate(spark):
    rows = [("a", 1, "GLY", 0.0, 0.0, 0.0, 1.0), ("a", 2, "GLY", 4.5, 0.0, 0.0, 1.0)]
    m = metrics(spark, rows)["a"]
    assert m.dist_nc == 4.5
    assert not m.cyclic_candidate
    assert m.score == pytest.approx(m.muH * 5.0 + 1.0)   # no penalty


def test_file_order_not_row_order(spark):
    rows = [("a", 3, "GLY", 9.0, 0.0, 0.0, 1.0), ("a", 1, "GLY", 0.0, 0.0, 0.0, 1.0),
            ("a", 2, "GLY", 5.0, 0.0, 0.0, 1.0)]
    assert metrics(spark, rows)["a"].dist_nc == 9.0


def test_matches_python_statement(spark):
    import random
    rnd = random.Random(3)
    names = ["ALA", "ARG", "ASP", "GLU", "LYS", "HIS", "TRP", "UNK"]
    rows = []
    for s in range(20):
        for o in range(1, rnd.randint(1, 9) + 1):
            rows.append((f"s{s}", o, rnd.choice(names), rnd.uniform(-9, 9), rnd.uniform(-9, 9),
                         rnd.uniform(-9, 9), rnd.uniform(0, 1)))
    got = metrics(spark, rows)
    for s in range(20):
        atoms = sorted([(r[2], r[1], r[3], r[4], r[5], r[6]) for r in rows if r[0] == f"s{s}"],
                       key=lambda a: a[1])
        exp = py_metrics(atoms)
        g = got[f"s{s}"]
        assert (g.net_charge, g.muH, g.plddt, g.dist_nc, g.score) == pytest.approx(exp, abs=1e-9)


def test_missing_coordinates_reject_the_structure_in_both_forms(spark):
    nan = float("nan")
    rows = [("a", 1, "ARG", 0.1, 0.2, 0.3, 0.9), ("a", 2, "TRP", 1.5, None, 0.0, 0.8),
            ("b", 1, "GLY", 5.0, nan, 5.0, 0.5), ("c", 1, "GLY", 1.0, 2.0, 3.0, None),
            ("c", 2, "ARG", 2.0, 2.0, 3.0, nan), ("c", 3, "ARG", 2.0, 4.0, 3.0, 0.5), (None, 1, "GLY", 1.0, 1.0, 1.0, 0.1)]
    got = metrics(spark, rows)
    assert set(got) == {"c", None} and got["c"].plddt == 0.5
    df = spark.createDataFrame(rows, SCHEMA)
    bad = {r.sid: (r.n_res, r.n_missing) for r in structure.incomplete_structures(df, ["sid"]).collect()}
    assert bad == {"a": (2, 1), "b": (1, 1)}
    arr = df.groupBy(F.col("sid").alias("id")).agg(F.sort_array(F.collect_list(F.struct("ord", "resname", "x", "y", "z", "plddt"))).alias("atoms"))
    both = {r.id: r for r in structure.structure_metrics_array(arr).collect()}
    assert set(both) == {"c", None} and both["c"].plddt == 0.5
    assert both["c"].muH == pytest.approx(got["c"].muH) and both["c"].dist_nc == pytest.approx(got["c"].dist_nc)
    assert {r.id for r in structure.incomplete_structures_array(arr).collect()} == {"a", "b"}


def test_array_form_equals_relational(spark):
    rows = [("a", 1, "ARG", 0.1, 0.2, 0.3, 0.9), ("a", 2, "TRP", 1.5, -0.2, 0.0, 0.8),
            ("a", 3, "ASP", 3.0, 1.0, 2.0, 0.7), ("b", 1, "GLY", 5.0, 5.0, 5.0, 0.5)]
    rel = metrics(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    arr = df.groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("ord", "resname", "x", "y", "z", "plddt"))).alias("atoms"))
    got = {r.sid: r for r in structure.structure_metrics_array(arr).collect()}
    for k in rel:
        assert (got[k].muH, got[k].net_charge, got[k].dist_nc, got[k].plddt) == pytest.approx(
            (rel[k].muH, rel[k].net_charge, rel[k].dist_nc, rel[k].plddt), abs=1e-12)


def test_translation_invariance(spark):
    rows = [("a", 1, "ARG", 0.1, 0.2, 0.3, 0.9), ("a", 2, "TRP", 1.5, -0.2, 0.0, 0.8),
            ("a", 3, "ASP", 3.0, 1.0, 2.0, 0.7)]
    moved = [(s, o, r, x + 10, y - 4, z + 2.5, b) for s, o, r, x, y, z, b in rows]
    a, b = metrics(spark, rows)["a"], metrics(spark, moved)["a"]
    assert a.score == pytest.approx(b.score, abs=1e-9)


def test_empty_input_gives_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert structure.structure_metrics(df, ["sid"], "ord").count() == 0


def test_rotation_invariance(spark):
    rows = [("a", 1, "ARG", 0.1, 0.2, 0.3, 0.9), ("a", 2, "TRP", 1.5, -0.2, 0.0, 0.8),
            ("a", 3, "ASP", 3.0, 1.0, 2.0, 0.7), ("a", 4, "LEU", -1.0, 2.5, 0.5, 0.6)]
    c, s = math.cos(0.7), math.sin(0.7)
    turned = [(sid, o, r, c * x - s * y, s * x + c * y, z, b) for sid, o, r, x, y, z, b in rows]
    a, b = metrics(spark, rows)["a"], metrics(spark, turned)["a"]
    assert (a.muH, a.dist_nc, a.score) == pytest.approx((b.muH, b.dist_nc, b.score), abs=1e-9)
