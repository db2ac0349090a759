"""All-atom reading and alignment, alternate locations, FASTA records at line
starts, the resumable stage, streaming batches and the bisecting guard."""

import math
import os
import time

import pytest
from pyspark.sql import functions as F

from seqscore.config import ScoringConfig
from seqscore.operators import validation
from seqscore.plans import resume, stages
from seqscore.runtime import guarded_map
from seqscore.sources import files as sources


def atom(n, name, res, chain, seq, xyz, icode=" ", alt=" ", occ=1.0, kind="ATOM  "):
    name = f" {name:<3}" if len(name) < 4 else name
    x, y, z = xyz
    return f"{kind}{n:5d} {name}{alt}{res} {chain}{seq:4d}{icode}   {x:8.3f}{y:8.3f}{z:8.3f}{occ:6.2f}{0.8:6.2f}           {name[1]}"


def structure_text(head, atoms, end="\n"):
    return end.join(([f"HEADER    {head}"] if head else []) + atoms + ["END", ""])


BEFORE = [atom(1, "N", "ALA", "A", 1, (0, 0, 0)), atom(2, "CA", "ALA", "A", 1, (1, 0, 0)),
          atom(3, "CA", "ALA", "A", 1, (2, 0, 0), icode="B"), atom(4, "CA", "ALA", "B", 1, (3, 0, 0)),
          atom(5, "HG11", "VAL", "B", 2, (4, 0, 0)), atom(6, "ZN", " ZN", "B", 3, (5, 0, 0), kind="HETATM")]


def moved(lines, by, order=-1):
    out = []
    for line in lines[::order]:
        out.append(line[:30] + f"{float(line[30:38]) + by:8.3f}" + line[38:])
    return out


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def test_atoms_are_aligned_by_name(spark, tmp_path):
    before, after = tmp_path / "b", tmp_path / "a"
    before.mkdir(), after.mkdir()
    cases = {"same": moved(BEFORE, 3.0), "lost": moved(BEFORE[1:], 1.0), "more": moved(BEFORE, 1.0) + [
        atom(9, "OXT", "VAL", "B", 2, (9, 9, 9))], "named": moved(BEFORE[:5], 1.0) + [BEFORE[5].replace(" ZN B", " ZN C")],
        "twice": moved(BEFORE, 1.0) + BEFORE[:1], "blank": [s[:30] + " " * 8 + s[38:] for s in BEFORE]}
    for k, lines in cases.items():
        write(before, f"{k}.pdb", structure_text(None, BEFORE))
        write(after, f"{k}.pdb", structure_text(None, lines))
    write(before, "alone.pdb", structure_text(None, BEFORE))
    write(after, "new.pdb", structure_text(None, BEFORE))
    b, a = (sources.explode_all_atoms(sources.read_pdb(spark, str(p), "*.pdb", all_atoms=True)) for p in (before, after))
    got = {r.id: tuple(r)[1:] for r in validation.displacement(b, a).collect()}
    assert got == {"same": (6, 3.0, 0, 0, None), "lost": (None, None, 1, 0, "atoms differ: 1 missing, 0 added"),
                   "more": (None, None, 0, 1, "atoms differ: 0 missing, 1 added"),
                   "named": (None, None, 1, 1, "atoms differ: 1 missing, 1 added"),
                   "twice": (None, None, 0, 0, "1 atoms named twice"),
                   "blank": (None, None, 0, 0, "6 atoms without coordinates"),
                   "alone": (None, None, 6, 0, "no atoms after"), "new": (None, None, 0, 6, "no atoms before")}


def test_models_and_alternate_locations_of_all_atoms(spark, tmp_path):
    lines = ["MODEL        1", atom(1, "CA", "ALA", "A", 1, (1, 0, 0), alt="A", occ=0.4),
             atom(2, "CA", "ALA", "A", 1, (2, 0, 0), alt="B", occ=0.6), atom(3, "CB", "ALA", "A", 1, (3, 0, 0), alt="B", occ=0.5),
             atom(4, "CB", "ALA", "A", 1, (4, 0, 0), alt="A", occ=0.5), "ENDMDL", "MODEL        2",
             atom(1, "CA", "ALA", "A", 1, (7, 0, 0)), "ENDMDL"]
    write(tmp_path, "m.pdb", structure_text("M", lines))
    (s,) = sources.read_pdb(spark, str(tmp_path), "*.pdb", all_atoms=True).collect()
    assert [(a.model, a.atom, a.x) for a in s.atoms] == [(1, "CA", 2.0), (1, "CB", 4.0), (2, "CA", 7.0)]


def test_many_alternate_locations_are_linear(spark, tmp_path):
    n = 9_999
    lines = []
    for i in range(1, n + 1):
        for chain in "AB":
            lines += [atom(1, "CA", "ALA", chain, i, (i % 900, 0, 0), alt=a, occ=o) for a, o in (("A", 0.3), ("B", 0.7))]
    write(tmp_path, "big.pdb", structure_text("BIG", lines))
    sources.read_pdb(spark, str(tmp_path), "*.none")
    t = time.time()
    (row,) = sources.read_pdb(spark, str(tmp_path), "*.pdb").select(F.size("atoms").alias("n")).collect()
    assert row.n == 2 * n and time.time() - t < 8


@pytest.mark.parametrize("end", ["\r\n", " " * 77 + "\n"])
def test_other_line_ends(spark, tmp_path, end):
    text = "".join(structure_text(h, BEFORE, "\n").replace("END\n", "END" + end) if end[0] == " " else
                   structure_text(h, BEFORE, end) for h in ("one", "two"))
    write(tmp_path, "x.pdb", text)
    for record_end in (sources.RECORD_END, "\nEND" + end if end[0] == " " else end + "END" + end):
        got = sources.read_pdb(spark, str(tmp_path), "*.pdb", all_atoms=True, record_end=record_end).collect()
        assert [(r.id, len(r.atoms)) for r in sorted(got, key=lambda r: r.id)] == [("one", 6), ("two", 6)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_fasta_signs_inside_headers(spark, tmp_path, end):
    write(tmp_path, "a.fasta", end.join([">seq_1 A|x>y", "AC", "DE", ">seq_2 B>", "", "GG", ">seq_3 C|z", "K", ""]))
    write(tmp_path, "b.fasta", f">A|protein{end}WW{end}")
    got = sorted((r.id, r.header, r.sequence) for r in sources.read_fasta(spark, str(tmp_path)).collect())
    assert got == [("b", "A|protein", "WW"), ("seq_1", "seq_1 A|x>y", "ACDE"), ("seq_2", "seq_2 B>", "GG"),
                   ("seq_3", "seq_3 C|z", "K")]


CA = [atom(i, "CA", "ARG", "A", i, (i, i % 2, 0)) for i in range(1, 6)]


def test_resumed_stage_reads_only_new_and_changed_files(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for k in range(5):
        write(src, f"seq_{k}.pdb", structure_text(None, CA))
    cfg = ScoringConfig()
    assert resume.score_new(spark, str(src), out, cfg, files_per_batch=2) == resume.Run(3, 5, 0)
    assert resume.score_new(spark, str(src), out, cfg) == resume.Run(0, 0, 5)
    write(src, "seq_5.pdb", structure_text(None, CA))
    write(src, "seq_2.pdb", structure_text(None, CA[:3]))
    assert resume.score_new(spark, str(src), out, cfg) == resume.Run(1, 2, 4)
    got = {r.id: r.n_res for r in resume.scored(spark, out).collect()}
    assert got == {**{f"seq_{k}": 5 for k in range(6)}, "seq_2": 3}


def test_batch_without_ledger_entry_is_done_again(spark, tmp_path, monkeypatch):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    write(src, "a.pdb", structure_text(None, CA))
    write_ = resume.Ledger.write

    def dies(self, name, df, batch):
        if name == "ledger":
            raise RuntimeError("lost")
        write_(self, name, df, batch)

    monkeypatch.setattr(resume.Ledger, "write", dies)
    with pytest.raises(RuntimeError):
        resume.score_new(spark, str(src), out)
    monkeypatch.undo()
    assert resume.scored(spark, out).count() == 0
    assert resume.score_new(spark, str(src), out).files_read == 1
    assert [r.id for r in resume.scored(spark, out).collect()] == ["a"]


def test_score_stage_resumes(spark, tmp_path):
    src, keep = tmp_path / "pdbs", str(tmp_path / "keep")
    src.mkdir()
    for k in range(6):
        write(src, f"seq_{k}.pdb", structure_text(None, moved(CA, k, 1)[:3 + k % 3]))
    full, _ = stages.score_and_pair(spark, str(src), str(tmp_path / "full"))
    for _ in range(2):
        some, prefs = stages.score_and_pair(spark, str(src), str(tmp_path / "resumed"), resume_from=keep)
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, full.collect())) and prefs.count() == 1


def test_validation_keeps_rows_of_structures_that_differ(spark, tmp_path):
    src, relaxed, out = tmp_path / "pdbs", tmp_path / "relaxed", tmp_path / "out"
    for d in (src, relaxed, out):
        d.mkdir()
    rows = ["id,sequence,net_charge,muH,plddt,dist_nc,score,cyclic_candidate,cys_count,rank"]
    energies = ["id,e_initial,e_final"]
    for k in range(4):
        write(src, f"seq_{k}.pdb", structure_text(None, BEFORE))
        write(relaxed, f"seq_{k}_relaxed.pdb", structure_text(None, moved(BEFORE[k == 2:], 2.0)))
        rows.append(f"seq_{k},ACD,0.1,0.2,0.8,9.0,{4 - k}.0,true,1,{k + 1}")
        energies.append(f"seq_{k},-1.0,-{10 + k}.0")
    write(out, "scored.csv", "\n".join(rows) + "\n")
    write(out, "energies.csv", "\n".join(energies) + "\n")
    table, _ = stages.validate(spark, str(out / "scored.csv"), str(out / "energies.csv"), str(src), str(out),
                               relaxed_dir=str(relaxed))
    got = {r.id: (r.n_atoms, r.rmsd) for r in table.collect()}
    assert got == {"seq_0": (6, 2.0), "seq_1": (6, 2.0), "seq_2": (None, None), "seq_3": (6, 2.0)}
    listed = sources.read_csv(spark, str(out / "structures_not_aligned"), "id STRING, error STRING").collect()
    assert [tuple(r) for r in listed] == [("seq_2", "atoms differ: 1 missing, 0 added")]
    report = sources.read_csv(spark, str(out / "validation_report"), "rank_physics INT, rank_proxy INT, sequence STRING, "
                              "e_final DOUBLE, delta_e DOUBLE, rmsd DOUBLE, plddt DOUBLE").collect()
    assert [(r.rank_physics, r.rank_proxy, r.rmsd) for r in report] == [(1, 4, 2.0), (2, 3, None), (3, 2, 2.0), (4, 1, 2.0)]


def test_replayed_stream_batch_doubles_nothing(spark, tmp_path, monkeypatch):
    from seqscore.streaming import incremental as inc
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    for k in range(4):
        write(src, f"f{k}.pdb", "".join(structure_text(f"s{k}_{j}", CA) for j in range(3)))
    writer = inc.write_batch

    def dying(out_dir):
        write_ = writer(out_dir)

        def run(batch, number):
            write_(batch, number)
            if number == 1:
                raise RuntimeError("killed after its rows were written")
        return run

    monkeypatch.setattr(inc, "write_batch", dying)
    with pytest.raises(Exception, match="killed"):
        inc.run_incremental(spark, src, out, ck, max_files_per_trigger=1)
    monkeypatch.undo()
    assert inc.run_incremental(spark, src, out, ck, max_files_per_trigger=1) >= 3
    assert sorted(r.id for r in inc.read_scored(spark, out).collect()) == sorted(
        f"s{k}_{j}" for k in range(4) for j in range(3))


def test_streamed_file_is_cut_while_being_read(spark, tmp_path):
    """One file of many structures is many records in several tasks."""
    from seqscore.streaming import incremental as inc
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    one = "\n".join(CA * 40)
    with open(os.path.join(src, "large.pdb"), "w") as f:
        for k in range(3000):
            f.write(f"HEADER    s{k}\n{one}\nEND\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    try:
        inc.run_incremental(spark, src, out, ck)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = inc.read_scored(spark, out)
    assert got.count() == got.select("id").distinct().count() == 3000
    assert got.filter("n_res = 200").count() == 3000
    files = spark.read.parquet(out).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 3


def test_guard_halves_around_failures(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(rows):
        calls.add(1)
        if (rows["v"] == 0).any():
            raise ZeroDivisionError("zero")
        return {"r": 1.0 / rows["v"], "s": [str(v) for v in rows["v"]]}

    n, bad = 4096, {5, 6, 4000}
    df = spark.createDataFrame([(i, 0.0 if i in bad else float(i + 1)) for i in range(n)], "id long, v double").coalesce(1)
    out = guarded_map(df, fn, "id long, r double, s string, error string", ["id"]).collect()
    assert [r.id for r in out] == list(range(n))
    for r in out:
        if r.id in bad:
            assert r.r is None and r.s is None and r.error == "ZeroDivisionError: zero"
        else:
            assert r.r == 1.0 / (r.id + 1) and r.s == str(float(r.id + 1)) and r.error is None
    assert calls.value < 2 * len(bad) * math.log2(n) + 10


def test_guard_with_wrong_lengths_missing_outputs_and_no_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    out = guarded_map(df, lambda rows: {"r": rows["id"][:0]}, "id long, r double, error string", ["id"]).collect()
    assert [r.error for r in out] == ["ValueError: 0 results for 1 rows"] * 2
    out = guarded_map(df, lambda rows: {}, "id long, r double, error string", ["id"]).collect()
    assert [(r.r, r.error) for r in out] == [(None, None)] * 2
    assert guarded_map(df.limit(0), lambda rows: {}, "id long, error string", ["id"]).count() == 0
