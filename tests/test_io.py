"""Sources, sinks, streaming, guarded map and runtime gates."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from seqscore.config import ConfigError, ScoringConfig, load_config
from seqscore.operators import structure
from seqscore.runtime import EmptyResult, InputMissing, guarded_map, require_non_empty, require_paths
from seqscore.sinks import files as sinks
from seqscore.sources import files as sources


def tmp():
    return tempfile.mkdtemp(prefix="seqscore-test-")


PDB = """HEADER    PEPTIDE
MODEL        1
ATOM      1  N   ALA A   1      11.104   6.134  -6.504  1.00  0.71           N
ATOM      2  CA  ALA A   1      11.639   6.071  -5.147  1.00  0.72           C
ATOM      3  CA ALYS A   2      12.000   7.000  -4.000  0.60  0.80           C
ATOM      4  CA BLYS A   2      12.500   7.500  -4.500  0.40  0.80           C
HETATM    5 CA    CA A 101       1.000   1.000   1.000  1.00  0.50          CA
ENDMDL
MODEL        2
ATOM      6  CA  GLU B   1      13.000   8.000  -3.000  1.00  0.90           C
ENDMDL
END
"""


def test_pdb_single_file_per_structure(spark):
    d = tmp()
    with open(os.path.join(d, "seq_7.pdb"), "w") as f:
        f.write(PDB.replace("HEADER    PEPTIDE\n", ""))
    s = sources.read_pdb(spark, d, "*.pdb").collect()
    assert len(s) == 1 and s[0].id == "seq_7"
    names = [a.resname for a in s[0].atoms]
    # of the locations of LYS, the one with the higher occupancy; the calcium named CA is kept (no record-type test)
    assert names == ["ALA", "LYS", "CA", "GLU"]
    assert s[0].atoms[0].x == 11.639 and s[0].atoms[0].plddt == 0.72


def test_pdb_roundtrip_relational(spark):
    atoms = spark.createDataFrame(
        [("seq_1", 1, "ARG", 1.0, 2.0, 3.0, 0.9), ("seq_1", 2, "ASP", 2.5, -1.25, 0.5, 0.8),
         ("seq_2", 1, "GLY", 0.0, 0.0, 0.0, 0.5)],
        "id string, ord long, resname string, x double, y double, z double, plddt double")
    path = sinks.write_pdb(atoms, os.path.join(tmp(), "pdb"), 2)
    back = sources.explode_atoms(sources.read_pdb(spark, path))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, atoms.collect()))
    m = structure.structure_metrics(back, ["id"], "ord").collect()
    assert {r.id for r in m} == {"seq_1", "seq_2"}


def test_fasta_roundtrip_and_legacy_file(spark):
    d = tmp()
    with open(os.path.join(d, "seq_3.fasta"), "w") as f:
        f.write(">A|protein\nACDE\nFGH\n")
    legacy = sources.read_fasta(spark, d, line2_only=True).collect()[0]
    assert (legacy.id, legacy.sequence) == ("seq_3", "ACDE")
    full = sources.read_fasta(spark, d).collect()[0]
    assert full.sequence == "ACDEFGH"
    df = spark.createDataFrame([("seq_1", " acd\n"), ("seq_2", "KK")], "id string, sequence string")
    p = sinks.write_fasta(df, os.path.join(tmp(), "fa"))
    got = {r.id: r.sequence for r in sources.read_fasta(spark, p).collect()}
    assert got == {"seq_1": "ACD", "seq_2": "KK"}


def test_csv_and_jsonl(spark):
    df = spark.createDataFrame([("seq_1", "seq_2", 0.5)], "chosen string, rejected string, margin double")
    p = sinks.write_jsonl(df, os.path.join(tmp(), "j"))
    assert sources.read_pairs(spark, p).collect() == df.collect()
    p2 = sinks.write_csv(spark.createDataFrame([("ACD", 1)], "sequence string, n int"), os.path.join(tmp(), "c"))
    assert sources.read_sequences_csv(spark, p2, "sequence STRING, n INT").collect()[0].n == 1
    empty = sinks.write_jsonl(df.limit(0), os.path.join(tmp(), "e"))
    assert sources.read_pairs(spark, empty).count() == 0


def test_json_summary_keeps_nulls(spark):
    df = spark.createDataFrame([(0, None)], "n_validated long, best_physics string")
    p = sinks.write_json_summary(df, os.path.join(tmp(), "s"))
    part = [f for f in os.listdir(p) if f.startswith("part-")][0]
    obj = json.loads(open(os.path.join(p, part)).read())
    assert obj == {"n_validated": 0, "best_physics": None}


def test_inventory_and_discovery(spark):
    d = tmp()
    os.makedirs(os.path.join(d, "inputs"))
    for name, body in (("seq_1.pdb", PDB), ("seq_2.pdb", "")):
        open(os.path.join(d, "inputs", name), "w").write(body)
    where = sources.discover(spark, os.path.join(d, "inputs", "prediction_results"), os.path.join(d, "inputs"))
    assert where.endswith("inputs")
    inv = {r.stem: r.length for r in sources.structure_inventory(spark, where, "*.pdb").collect()}
    # zero-length files produce no scan splits: an empty output counts as
    # not processed (J6), exactly like the size > 0 rule
    assert "seq_2" not in inv and inv["seq_1"] > 0
    assert sources.discover(spark, os.path.join(d, "nope"), os.path.join(d, "nope2")) is None


def test_stream_is_resumable(spark):
    from seqscore.streaming.incremental import read_scored, run_incremental
    src, out, ck = tmp(), tmp(), tmp()
    open(os.path.join(src, "a.pdb"), "w").write(PDB)
    assert run_incremental(spark, src, out, ck, ScoringConfig()) == 1
    assert run_incremental(spark, src, out, ck, ScoringConfig()) == 0     # nothing new
    open(os.path.join(src, "b.pdb"), "w").write(PDB.replace("PEPTIDE", "OTHER"))
    run_incremental(spark, src, out, ck, ScoringConfig())
    assert sorted(r.id for r in read_scored(spark, out).collect()) == ["OTHER", "PEPTIDE"]


def test_guarded_map(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 0.0)], "id string, v double")

    def inv(rows):
        if (rows["v"] == 0).any():
            raise ZeroDivisionError("float division by zero")
        return {"r": 1 / rows["v"]}

    got = {r.id: r for r in guarded_map(df, inv, "id string, r double, error string", ["id"]).collect()}
    assert got["a"].r == 0.5 and got["a"].error is None
    assert got["b"].r is None and got["b"].error.startswith("ZeroDivisionError")


def test_gates(spark):
    with pytest.raises(InputMissing):
        require_paths(spark, ["/nonexistent/path/x.csv"])
    with pytest.raises(EmptyResult):
        require_non_empty(spark.range(0))
    assert require_non_empty(spark.range(1)).count() == 1


def test_config_loading(monkeypatch):
    assert load_config('{"anionic_fraction": 1, "extra": 3}').anionic_fraction == 1.0
    monkeypatch.setenv("SCORING_CONFIG", '{"cyclicity_penalty_threshold": 8.0}')
    assert load_config().cyclicity_penalty_threshold == 8.0
    with pytest.raises(ConfigError):
        load_config("{bad")
    assert load_config("{bad", on_bad_json="default") == ScoringConfig()


def test_assign_ids_follow_file_order(spark):
    d = tmp()
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("sequence\n" + "\n".join(f"S{i:03d}" for i in range(50)) + "\n")
    df = sources.assign_ids(spark.read.schema("sequence STRING").option("header", True).csv(d))
    got = sorted((r.seq_idx, r.id, r.sequence) for r in df.collect())
    assert got == [(i, f"seq_{i}", f"S{i:03d}") for i in range(50)]


def test_legacy_ids_lexicographic(spark):
    d = tmp()
    for k in (0, 1, 2, 10):
        open(os.path.join(d, f"seq_{k}.pdb"), "w").write(PDB.replace("HEADER    PEPTIDE\n", ""))
    s = sources.legacy_ids(sources.read_pdb(spark, d, "*.pdb"))
    got = {r.id: r.legacy_id for r in s.collect()}
    assert got == {"seq_0": "seq_0", "seq_1": "seq_1", "seq_10": "seq_2", "seq_2": "seq_3"}


ATOMS = "id string, ord long, resname string, x double, y double, z double, plddt double"


@pytest.mark.parametrize("n", [10_050, 150_000])
def test_pdb_writer_keeps_large_structures(spark, n):
    atoms = spark.range(1, n + 1).select(
        F.lit("big").alias("id"), F.col("id").alias("ord"), F.lit("GLY").alias("resname"),
        (F.col("id") % 9000 / 8).alias("x"), (-F.col("id") % 777 / 4).alias("y"), F.lit(-0.5).alias("z"),
        F.lit(0.75).alias("plddt"))
    path = sinks.write_pdb(atoms, os.path.join(tmp(), "big"), 2)
    back = sources.explode_atoms(sources.read_pdb(spark, path))
    assert back.count() == n
    assert back.exceptAll(atoms).count() == 0


@pytest.mark.parametrize("atom", [("GLY", 123456.5, 0.0), ("GLY", 0.0, -12345.678), ("LONG", 0.0, 0.0)])
def test_pdb_writer_fails_where_a_field_does_not_fit(spark, atom):
    res, x, y = atom
    atoms = spark.createDataFrame([("s", 1, res, x, y, 0.0, 0.5)], ATOMS)
    with pytest.raises(Exception, match="doesn't fit"):
        sinks.write_pdb(atoms, os.path.join(tmp(), "wide"), 1)


def test_pdb_fields_at_their_limits(spark):
    atoms = spark.createDataFrame([("s", 1, "GLY", 9999.999, -999.999, None, 0.5)], ATOMS)
    back = sources.explode_atoms(sources.read_pdb(spark, sinks.write_pdb(atoms, os.path.join(tmp(), "w"), 1)))
    assert back.collect() == atoms.collect()


ALT = """ATOM      1  CA AARG A   1       1.000   1.000   1.000  0.20  0.10           C
ATOM      2  CA BARG A   1       2.000   1.000   1.000  0.80  0.20           C
ATOM      3  CA BGLY A   2       3.000   1.000   1.000  1.00  0.30           C
ATOM      4  CA 1SER A   3       4.000   1.000   1.000  0.50  0.40           C
ATOM      5  CA 2SER A   3       5.000   1.000   1.000  0.50  0.50           C
ATOM      6  CA  ALA A   3A      6.000     nan   1.000  1.00  0.60           C
MODEL        2
ATOM      7  CA AARG A   1       7.000   1.000   1.000  0.20  0.70           C
ENDMDL
END
"""


def test_alternate_locations_by_occupancy(spark):
    d = tmp()
    with open(os.path.join(d, "a.pdb"), "w") as f:
        f.write(ALT)
    (s,) = sources.read_pdb(spark, d, "*.pdb").collect()
    assert [(a.resname, a.x, a.y) for a in s.atoms] == [
        ("ARG", 2.0, 1.0), ("GLY", 3.0, 1.0), ("SER", 4.0, 1.0), ("ALA", 6.0, None), ("ARG", 7.0, 1.0)]


def test_discovery_falls_back_and_stays_in_the_folder(spark):
    d = tmp()
    os.makedirs(os.path.join(d, "prediction_results", "relaxed"))
    for name in ("x.pdb", "prediction_results/relaxed/y.pdb"):
        open(os.path.join(d, name), "w").write(PDB)
    assert sources.discover(spark, os.path.join(d, "prediction_results"), d) == d
    assert sources.read_pdb(spark, d, "*.pdb").count() == 1
    assert [r.stem for r in sources.structure_inventory(spark, d, "*.pdb").collect()] == ["x"]
    ids = spark.createDataFrame([("x",), ("z",)], "id string")
    done, left = sources.pending(ids, sources.structure_inventory(spark, d, "*.pdb"))
    assert [r.id for r in done.collect()] == ["x"] and [r.id for r in left.collect()] == ["z"]


def test_structures_without_ca_are_listed(spark):
    d = tmp()
    open(os.path.join(d, "n.pdb"), "w").write(PDB.replace(" CA ", " CB ").replace("CA  ", "CB  "))
    open(os.path.join(d, "y.pdb"), "w").write(PDB)
    assert [r.file_name for r in sources.without_ca(sources.read_pdb(spark, d, "*.pdb")).collect()] == ["n.pdb"]


def test_csv_by_header_name(spark):
    d = tmp()
    for name, head, row in (("a.csv", "name,sequence,n", "x,ACD,1"), ("b.csv", "name,sequence,n", "y,DEF,nan")):
        open(os.path.join(d, name), "w").write(f"{head}\n{row}\n")
    got = sources.read_csv(spark, d, "n DOUBLE, sequence STRING").orderBy("name").collect()
    assert [tuple(r) for r in got] == [(1.0, "ACD", "x"), (None, "DEF", "y")]
    with pytest.raises(ValueError, match="no column score"):
        sources.read_csv(spark, d, "score DOUBLE")
    open(os.path.join(d, "c.csv"), "w").write("sequence,name,n\nACD,z,2\n")
    with pytest.raises(Exception):
        sources.read_csv(spark, d, "n DOUBLE, sequence STRING").collect()


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from seqscore.session import ensure_checkpoint_dir
    for master, ok in (("local[4]", True), ("local", True), ("yarn", False), ("spark://host:7077", False),
                       ("local-cluster[2,1,1024]", False)):
        made = []
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, default: default), sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None, setCheckpointDir=made.append))
        if ok:
            assert ensure_checkpoint_dir(fake) == made[0]
        else:
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                ensure_checkpoint_dir(fake)


def test_fasta_short_record_skip_or_raise(spark):
    d = tmp()
    with open(os.path.join(d, "seq_1.fasta"), "w") as f:
        f.write(">A|protein\nACD\n")
    with open(os.path.join(d, "seq_2.fasta"), "w") as f:
        f.write(">A|protein\n")
    assert [r.id for r in sources.read_fasta(spark, d).collect()] == ["seq_1"]
    with pytest.raises(Exception):
        sources.read_fasta(spark, d, on_short="raise").collect()
