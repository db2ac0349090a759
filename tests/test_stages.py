"""The stage entry points chained end to end on small hand-made files."""

import json
import os
import random
import tempfile

import pytest

from seqscore.plans import stages

RES = ["ALA", "ARG", "ASP", "GLU", "LYS", "LEU", "CYS", "TRP"]
ONE = {"ALA": "A", "ARG": "R", "ASP": "D", "GLU": "E", "LYS": "K", "LEU": "L", "CYS": "C", "TRP": "W"}


def pdb_text(rnd, n):
    lines, seq = [], ""
    for i in range(1, n + 1):
        r = rnd.choice(RES)
        seq += ONE[r]
        x, y, z = (rnd.uniform(-9, 9) for _ in range(3))
        lines.append(f"ATOM  {i:5d}  CA  {r} A{i:4d}    {x:8.3f}{y:8.3f}{z:8.3f}  1.00{rnd.uniform(0.3, 0.95):6.2f}           C")
    return "\n".join(lines) + "\nEND\n", seq


def read_csv_dir(path):
    import glob
    import pandas as pd
    return pd.concat([pd.read_csv(f) for f in sorted(glob.glob(os.path.join(path, "part-*.csv")))])


def test_stages_end_to_end(spark, caplog):
    import logging
    caplog.set_level(logging.INFO, logger="seqscore.stages")
    rnd = random.Random(11)
    root = tempfile.mkdtemp(prefix="seqscore-stages-")
    pdb_dir = os.path.join(root, "pdbs")
    os.makedirs(pdb_dir)
    seqs = []
    for k in range(12):
        text, seq = pdb_text(rnd, rnd.randint(3, 9))
        seqs.append(seq)
        with open(os.path.join(pdb_dir, f"seq_{k}.pdb"), "w") as f:
            f.write(text)
    seq_csv = os.path.join(root, "sequences.csv")
    with open(seq_csv, "w") as f:
        f.write("sequence\n" + "\n".join(f" {s.lower()} " for s in seqs) + "\n")

    out = os.path.join(root, "out")
    ing = stages.ingest(spark, seq_csv, out).collect()
    assert [r.sequence for r in ing] == seqs
    assert "ingest: 12 sequences" in caplog.text          # counted while writing
    stages.prepare_fasta(spark, seq_csv, out, limit=5)

    scored, prefs = stages.score_and_pair(spark, pdb_dir, out)
    assert scored.count() == 12 and prefs.count() == 2          # int(12 * 0.2)
    assert "12 structures scored, 2 preference pairs" in caplog.text
    trip = stages.build_triplets(spark, os.path.join(out, "preferences"), seq_csv, out).collect()
    assert len(trip) == 2 and all(t.chosen in seqs and t.rejected in seqs for t in trip)

    table, summary = stages.score_generated(spark, seq_csv, pdb_dir, out)
    t = {r.id: r for r in table.collect()}
    assert all(t[f"seq_{k}"].sequence == seqs[k] for k in range(12))
    assert sorted(r.rank for r in t.values()) == list(range(1, 13))
    assert summary.collect()[0].n_scored == 12

    energies = os.path.join(root, "energies.csv")
    with open(energies, "w") as f:
        f.write("id,e_initial,e_final\n")
        for k in range(12):
            if k != 3:
                f.write(f"seq_{k},{rnd.uniform(-500, 4000):.2f},{rnd.uniform(-5000, -1000):.2f}\n")
    vt, vs = stages.validate(spark, os.path.join(out, "scored_generated"), energies, pdb_dir, out, top_n=6)
    rows = vt.collect()
    assert len(rows) == 6
    s = vs.collect()[0]
    assert s.n_total == 6 and s.n_validated == sum(r.e_final is not None for r in rows)
    part = [p for p in os.listdir(os.path.join(out, "validation_summary")) if p.startswith("part-")][0]
    obj = json.loads(open(os.path.join(out, "validation_summary", part)).read())
    assert obj["forcefield"].startswith("AMBER14") and "mean_delta_e" in obj
    df = read_csv_dir(os.path.join(out, "physics_validation"))
    assert list(df["rank_proxy"]) == list(range(1, len(df) + 1)) or df["rank_proxy"].isna().any()


def test_cli_runs_a_stage():
    import subprocess
    import sys
    root = tempfile.mkdtemp(prefix="seqscore-cli-")
    csv = os.path.join(root, "s.csv")
    with open(csv, "w") as f:
        f.write("sequence\nacdk\nKKRW\n")
    out = os.path.join(root, "out")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "seqscore", "--master", "local[2]", "fasta", csv, out],
                       cwd=repo, capture_output=True, text=True, timeout=300)
    assert r.returncode == 0, r.stderr[-2000:]
    text = "".join(open(os.path.join(out, "fasta_inputs", f)).read()
                   for f in os.listdir(os.path.join(out, "fasta_inputs")) if f.startswith("part-"))
    assert ">seq_0 A|protein\nACDK" in text and ">seq_1 A|protein\nKKRW" in text


def test_rejected_sequences_side_table(spark):
    root = tempfile.mkdtemp(prefix="seqscore-rej-")
    csv = os.path.join(root, "s.csv")
    with open(csv, "w") as f:
        # a quoted empty value, a quoted blank value (unquoted blank lines are
        # skipped by the reader, as by pandas)
        f.write('sequence\nacdk\n""\n" \t"\nKKRW\n')
    out = os.path.join(root, "out")
    ing = stages.ingest(spark, csv, out).collect()
    assert [r.sequence for r in ing] == ["ACDK", "KKRW"]
    rej = spark.read.option("header", True).csv(os.path.join(out, "ingest_rejected")).collect()
    assert sorted(r.id for r in rej) == ["seq_1", "seq_2"]
    fa = stages.prepare_fasta(spark, csv, out).count()
    assert fa == 2
