"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame built from the given tables.  Column names match the SQL in
``seqscore.plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.config import ScoringConfig
from seqscore.functions.numeric import round_dp, score_key
from seqscore.operators import pairs, ranking, structure
from seqscore.session import cut_lineage
from seqscore.sources import fixtures

CFG = ScoringConfig()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# -- shared building blocks ---------------------------------------------------

SCORED = ["net_charge", "muH", "plddt", "dist_nc", "score"]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_idx, id, n_res, net_charge, muH, plddt, dist_nc, score (doubles as
    published, 6 dp), cyclic_candidate, and raw_score, the unrounded score
    that ranks and margins are taken from."""
    atoms = fixtures.ca_atoms(spark, sf_dir)
    s = structure.score_structures(atoms, ["seq_idx"], "ord_key", CFG).withColumn("raw_score", F.col("score"))
    return structure.rounded(s, SCORED).withColumn("id", fixtures.structure_id())


def by_score() -> list:
    """Rank order: best unrounded score first, the key decides ties."""
    return [score_key("raw_score").desc_nulls_last(), F.col("seq_idx")]


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.global_rank(scores(spark, sf_dir), by_score())


def _margins(pairs_df: DataFrame) -> DataFrame:
    """Margins as published, 6 dp."""
    return pairs_df.withColumn("margin", round_dp("margin", 6))


# -- structure scoring ----------------------------------------------------------

@query
def structure_metrics(spark, sf_dir):
    atoms = fixtures.ca_atoms(spark, sf_dir)
    m = structure.structure_metrics(atoms, ["seq_idx"], "ord_key")
    m = structure.rounded(m, ["net_charge", "muH", "plddt", "dist_nc"])
    return m.select(fixtures.structure_id().alias("id"), "n_res", "net_charge", "muH", "plddt",
                    "dist_nc")


@query
def composite_score(spark, sf_dir):
    return scores(spark, sf_dir).select("id", "n_res", "net_charge", "muH", "plddt", "dist_nc",
                                        "score", "cyclic_candidate")


@query
def top_candidates(spark, sf_dir):
    s = scores(spark, sf_dir)
    return ranking.top_n(s, by_score(), C.DEFAULT_TOP_N).select(
        "id", "score", "plddt", "dist_nc", "muH", "net_charge")


@query
def global_rank(spark, sf_dir):
    return ranked(spark, sf_dir).select("id", "score", "rank")


@query
def winner_loser_split(spark, sf_dir):
    r = ranking.top_fraction_split(ranked(spark, sf_dir), C.WINNER_FRACTION)
    return r.select("id", "score", "rank", "is_winner")


@query
def preference_pairs(spark, sf_dir):
    return _margins(pairs.preference_pairs(ranked(spark, sf_dir), score_col="raw_score"))


# -- physics validation ---------------------------------------------------------

def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy rows for every scored structure with proxy/physics ranks."""
    from seqscore.operators import validation
    s = scores(spark, sf_dir).withColumn("score", F.col("raw_score"))
    rows = validation.energy_rows(fixtures.energies(spark, sf_dir, s))
    return validation.rank_validation(rows).withColumn("raw_score", F.col("proxy_score")).withColumn(
        "proxy_score", round_dp("proxy_score", 6))


VALIDATION_COLUMNS = ["id", "proxy_score", "plddt", "dist_nc", "muH", "net_charge", "e_initial",
                      "e_final", "delta_e", "converged", "rank_proxy", "rank_physics"]


@query
def energy_validation(spark, sf_dir):
    return validated(spark, sf_dir).select(*VALIDATION_COLUMNS)


@query
def rank_correlation(spark, sf_dir):
    from seqscore.operators import validation
    return validation.rank_correlation(validated(spark, sf_dir))


@query
def validation_summary(spark, sf_dir):
    from seqscore.operators import validation
    return validation.validation_summary(validated(spark, sf_dir), best="raw_score")


@query
def rmsd(spark, sf_dir):
    from seqscore.operators import validation
    before = fixtures.ca_atoms_dealt(spark, sf_dir)
    after = fixtures.relaxed_atoms(before)
    return validation.rmsd(before, after).select(fixtures.structure_id().alias("id"), "rmsd",
                                                 "n_atoms")


@query
def rmsd_all_atoms(spark, sf_dir):
    """All atoms of the structures before and after relaxation,
    written as PDB files, read back and aligned by chain, residue and name;
    structures whose sides differ become NULL rows with their error."""
    from seqscore.operators import validation
    from seqscore.sinks.files import write_pdb
    from seqscore.sources.files import explode_all_atoms, read_pdb
    before = fixtures.all_atoms(spark, sf_dir)
    sides = []
    for name, atoms in (("pdb_before", before), ("pdb_after", fixtures.relaxed_all_atoms(before))):
        path = write_pdb(atoms, _scratch(spark, name), _n_files(spark), order_col="ord", all_atoms=True)
        sides.append(explode_all_atoms(read_pdb(spark, path, all_atoms=True)))
    return validation.displacement(*sides)


# -- sequences -----------------------------------------------------------------

def _peptides(spark, sf_dir):
    return fixtures.peptides(spark, sf_dir)


@query
def normalize_ids(spark, sf_dir):
    """P1/P4/P5/F9/P18/P19 over every document-derived sequence (the raw
    form wraps the sequence in whitespace and lower-cases it)."""
    from seqscore.functions import sequence as S
    p = _peptides(spark, sf_dir)
    raw = F.concat(F.lit(" \t"), F.lower(F.col("sequence")), F.lit("\n"))
    norm = S.normalize_sequence(raw)
    return p.select(
        "id", S.parse_id(F.col("id")).alias("parsed_idx"),
        norm.alias("normalized"), (norm == F.col("sequence")).alias("roundtrip_ok"),
        S.cys_count(norm).alias("cys_count"), S.clean_generated(norm).alias("cleaned"),
        S.preview(norm).alias("preview"))


@query
def hydrophobicity(spark, sf_dir):
    from seqscore.functions import sequence as S
    p = _peptides(spark, sf_dir)
    return p.select("id", round_dp(S.hydrophobicity(F.col("sequence")), 6).alias("hydrophobicity"))


@query
def charge(spark, sf_dir):
    from seqscore.functions import sequence as S
    p = _peptides(spark, sf_dir)
    return p.select("id", round_dp(S.charge(F.col("sequence"), 7.4), 6).alias("charge"))


@query
def isoelectric_point(spark, sf_dir):
    from seqscore.functions import sequence as S
    p = S.isoelectric_point(_peptides(spark, sf_dir))
    return p.select("id", round_dp(F.col("isoelectric_point"), 4).alias("isoelectric_point"))


@query
def instability(spark, sf_dir):
    from seqscore.operators.descriptors import instability_index
    p = _peptides(spark, sf_dir)
    ii = instability_index(p, fixtures.synthetic_weights(spark))
    return ii.select(fixtures.structure_id().alias("id"),
                     round_dp(F.col("instability_index"), 6).alias("instability_index"))


@query
def descriptors(spark, sf_dir):
    """The four descriptors appended to the sequence rows (with
    passthrough columns); limit 0 = all rows."""
    from seqscore.operators.descriptors import descriptors as describe
    p = fixtures.peptides(spark, sf_dir, ("lang", "source"))
    return _described(describe(p, fixtures.synthetic_weights(spark)))


@query
def descriptors_first(spark, sf_dir):
    """Descriptors of the first 100 sequences by position, the feature
    that the limit is."""
    from seqscore.operators.descriptors import descriptors as describe
    p = fixtures.peptides(spark, sf_dir, ("lang", "source"))
    return _described(describe(p, fixtures.synthetic_weights(spark), limit=100))


def _described(d: DataFrame) -> DataFrame:
    return d.select("id", "lang", "source", F.length("sequence").cast("bigint").alias("length"),
                    round_dp(F.col("hydrophobicity"), 6).alias("hydrophobicity"),
                    round_dp(F.col("charge"), 6).alias("charge"),
                    round_dp(F.col("instability_index"), 6).alias("instability_index"),
                    round_dp(F.col("isoelectric_point"), 4).alias("isoelectric_point"))


@query
def attach_sequence(spark, sf_dir):
    """The scored table with the sequence looked up by
    index (missing -> ''), Cys count and rank, in the fixed column order."""
    from seqscore.functions import sequence as S
    r = ranked(spark, sf_dir)
    p = _peptides(spark, sf_dir).select("seq_idx", "sequence")
    j = r.join(p, "seq_idx", "left").withColumn("sequence", F.coalesce(F.col("sequence"), F.lit("")))
    ordered = ["id", "sequence", "net_charge", "muH", "plddt", "dist_nc", "score",
               "cyclic_candidate", "cys_count", "rank"]
    j = j.withColumn("cys_count", S.cys_count(F.col("sequence")))
    return j.select(*[c for c in ordered if c in j.columns])


@query
def training_triplets(spark, sf_dir):
    pr = pairs.preference_pairs(ranked(spark, sf_dir), score_col="raw_score")
    return pairs.training_triplets(pr, _peptides(spark, sf_dir), on_missing="null")


# -- joins ---------------------------------------------------------------------

@query
def nearest_join(spark, sf_dir):
    """J4 general form: every purchase event paired with the same user's
    view event of nearest value."""
    from seqscore.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    left = ev.filter(F.col("event_type") == "purchase")
    right = ev.filter(F.col("event_type") == "view").withColumnRenamed("event_id", "view_id")
    j = pairs.nearest_join(left, right, "value", ["user_id"], "event_id", "view_id")
    return j.select("user_id", F.col("event_id").alias("purchase_id"),
                    F.col("left_key").alias("purchase_value"), "view_id",
                    F.col("right_key").alias("view_value"))


def _finished_orders(spark, sf_dir):
    from seqscore.sources.tables import read_table
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    return o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("seq_idx"))


@query
def existing_semi(spark, sf_dir):
    """Scored structures whose relaxed structure exists (finished order)."""
    return scores(spark, sf_dir).join(_finished_orders(spark, sf_dir), "seq_idx", "left_semi") \
        .select("id", "score")


@query
def pending_anti(spark, sf_dir):
    """Scored structures still to be processed (no finished output)."""
    return scores(spark, sf_dir).join(_finished_orders(spark, sf_dir), "seq_idx", "left_anti") \
        .select("id", "score")


@query
def scale_join(spark, sf_dir):
    """Residues joined to the (20-row, broadcast) scale table;
    structures holding residues outside the scale, with their share."""
    from seqscore.operators.lookup import scale_table
    atoms = fixtures.ca_atoms(spark, sf_dir)
    j = atoms.join(F.broadcast(scale_table(spark)), "resname", "left")
    agg = j.groupBy("seq_idx").agg(
        F.count(F.lit(1)).alias("n_res"),
        F.count_if(F.col("h").isNull()).alias("n_unknown"),
        F.sum(F.coalesce(F.col("h"), F.lit(0.0))).alias("_h"))
    return agg.filter(F.col("n_unknown") > 0).select(
        fixtures.structure_id().alias("id"), "n_res", "n_unknown",
        round_dp(F.col("_h"), 6).alias("h_sum"))


# -- reports ---------------------------------------------------------------------

@query
def row_counts(spark, sf_dir):
    """Rows in (atoms), structures out, score range."""
    s = scores(spark, sf_dir)
    return s.agg(F.sum("n_res").alias("n_atoms"), F.count(F.lit(1)).alias("n_structures"),
                 F.min("score").alias("min_score"), F.max("score").alias("max_score"))


@query
def batch_summary(spark, sf_dir):
    from seqscore.operators import reports
    from seqscore.functions import sequence as S
    cys = _peptides(spark, sf_dir).select("seq_idx", S.cys_count(F.col("sequence")).alias("cys_count"))
    return reports.batch_summary(scores(spark, sf_dir).join(cys, "seq_idx", "left"))


@query
def margin_stats(spark, sf_dir):
    from seqscore.operators import reports
    return reports.margin_stats(preference_pairs(spark, sf_dir))


@query
def reject_diversity(spark, sf_dir):
    from seqscore.operators import reports
    return reports.reject_diversity(preference_pairs(spark, sf_dir))


def _cohorts(spark, sf_dir):
    """Scores with a cohort label: 'original' for finished orders, else
    'generated'."""
    fin = _finished_orders(spark, sf_dir).withColumn("_fin", F.lit(True))
    s = scores(spark, sf_dir).join(fin, "seq_idx", "left")
    labelled = s.withColumn("cohort", F.when(F.col("_fin"), F.lit("original")).otherwise(F.lit("generated")))
    # scored once: each report reads these rows more than once
    return cut_lineage(labelled.select("seq_idx", "cohort", "score", "dist_nc"))


@query
def above_p90(spark, sf_dir):
    from seqscore.operators import reports
    return reports.above_percentile(_cohorts(spark, sf_dir), "cohort", "original", "generated",
                                    0.9, "score")


@query
def score_hist(spark, sf_dir):
    from seqscore.operators import reports
    return reports.histogram(_cohorts(spark, sf_dir), "score", ["cohort"], 20)


@query
def dist_hist(spark, sf_dir):
    """End-to-end distances by cohort."""
    from seqscore.operators import reports
    return reports.histogram(_cohorts(spark, sf_dir), "dist_nc", ["cohort"], 20)


@query
def chart_sets(spark, sf_dir):
    """V1-V4 in one table: pLDDT vs score with a validated flag, muH vs net
    charge, proxy vs physics rank, Cys badge."""
    from seqscore.functions import sequence as S
    v = validated(spark, sf_dir)
    p = _peptides(spark, sf_dir).select("seq_idx", S.cys_count(F.col("sequence")).alias("_cys"))
    j = v.join(p, "seq_idx", "left")
    return j.select("id", "plddt", F.col("proxy_score").alias("score"),
                    F.col("e_final").isNotNull().alias("validated"), "muH", "net_charge",
                    "rank_proxy", "rank_physics",
                    (F.coalesce(F.col("_cys"), F.lit(0)) >= 2).alias("cys_badge"))


@query
def ranked_report(spark, sf_dir):
    """The first ten ranks of the scored table."""
    from seqscore.functions import sequence as S
    top = ranking.top_n(scores(spark, sf_dir), by_score(), C.DEFAULT_TOP_N)
    # ten rows: their ranks and their sequences
    top = top.withColumn("rank", F.row_number().over(Window.orderBy(*by_score())).cast("bigint"))
    t = F.broadcast(top).join(_peptides(spark, sf_dir).select("seq_idx", "sequence"), "seq_idx", "left")
    t = t.withColumn("sequence", F.coalesce("sequence", F.lit("")))
    return t.withColumn("cys_count", S.cys_count(F.col("sequence"))).select(
        "rank", "sequence", "score", "plddt", "dist_nc", "cyclic_candidate", "cys_count")


@query
def validation_report(spark, sf_dir):
    """Succeeded rows with both ranks, sequence, energies, RMSD, pLDDT."""
    from seqscore.operators import validation
    before = fixtures.ca_atoms_dealt(spark, sf_dir)
    moved = validation.rmsd(before, fixtures.relaxed_atoms(before)).select("seq_idx", "rmsd")
    rows = (validated(spark, sf_dir).join(moved, "seq_idx", "left")
            .join(_peptides(spark, sf_dir).select("seq_idx", "sequence"), "seq_idx", "left"))
    return validation.report(rows.withColumn("sequence", F.coalesce("sequence", F.lit(""))), "id")


@query
def candidate_table(spark, sf_dir):
    """V4: every candidate in rank order with its sequence, metrics and the
    badge of two or more Cys."""
    from seqscore.functions import sequence as S
    p = _peptides(spark, sf_dir).select("seq_idx", "sequence")
    j = ranked(spark, sf_dir).join(p, "seq_idx", "left").withColumn("sequence", F.coalesce("sequence", F.lit("")))
    return (j.withColumn("cys_count", S.cys_count(F.col("sequence"))).withColumn("cys_badge", F.col("cys_count") >= 2)
            .select("rank", "id", "sequence", "score", "plddt", "dist_nc", "muH", "net_charge", "cyclic_candidate",
                    "cys_count", "cys_badge").orderBy("rank"))


@query
def stratified_pairs(spark, sf_dir):
    return _margins(pairs.stratified_pairs(ranked(spark, sf_dir), score_col="raw_score"))


# -- sources and sinks (round trips through the shared checkpoint folder) ---------

def _scratch(spark, name):
    from seqscore.session import scratch_path
    return scratch_path(spark, name)


SCORED_SCHEMA = ("id STRING, n_res BIGINT, net_charge DOUBLE, muH DOUBLE, plddt DOUBLE, "
                 "dist_nc DOUBLE, score DOUBLE, cyclic_candidate BOOLEAN")


@query
def csv_roundtrip(spark, sf_dir):
    """K1 then S1: the scored table written as CSV and read back typed."""
    from seqscore.sinks.files import write_csv
    from seqscore.sources.files import read_csv
    path = write_csv(composite_score(spark, sf_dir), _scratch(spark, "scored_csv"))
    return read_csv(spark, path, SCORED_SCHEMA)


@query
def csv_ids(spark, sf_dir):
    """Sequences written as CSV in document order, with columns before
    and behind the sequence, read by header name and numbered by position."""
    from seqscore.sinks.files import write_csv
    from seqscore.sources.files import assign_ids, read_csv
    p = fixtures.peptides(spark, sf_dir, ("lang", "source")).orderBy("seq_idx")
    path = write_csv(p.select("lang", F.col("seq_idx").alias("doc"), "sequence", "source"),
                     _scratch(spark, "sequences_csv"))
    ids = assign_ids(read_csv(spark, path, "sequence STRING, doc BIGINT"))
    return ids.select("id", "doc", "lang", "source", F.length("sequence").cast("bigint").alias("length"))


@query
def jsonl_roundtrip(spark, sf_dir):
    """K2 then S4: preference pairs as JSON lines."""
    from seqscore.sinks.files import write_jsonl
    from seqscore.sources.files import read_pairs
    path = write_jsonl(preference_pairs(spark, sf_dir), _scratch(spark, "pairs_jsonl"))
    return read_pairs(spark, path)


SUMMARY_SCHEMA = ("n_validated BIGINT, n_total BIGINT, spearman_rho DOUBLE, spearman_pval DOUBLE, "
                  "interpretation STRING, forcefield STRING, best_proxy STRING, best_physics STRING, "
                  "mean_delta_e DOUBLE")


@query
def summary_roundtrip(spark, sf_dir):
    """K3 then F11: the one-object validation summary."""
    from seqscore.sinks.files import write_json_summary
    from seqscore.sources.files import read_json
    path = write_json_summary(validation_summary(spark, sf_dir), _scratch(spark, "summary_json"))
    return read_json(spark, path, SUMMARY_SCHEMA)


@query
def fasta_roundtrip(spark, sf_dir):
    """K4/F10 then S2: every sequence as a FASTA record and back."""
    from seqscore.sinks.files import write_fasta
    from seqscore.sources.files import read_fasta
    path = write_fasta(_peptides(spark, sf_dir), _scratch(spark, "fasta"))
    return read_fasta(spark, path).select("id", "sequence")


def _pdb_atoms(spark, sf_dir):
    """CA atoms with the structure id; the writer numbers positions from the
    file-order key itself (``order_col``)."""
    return fixtures.ca_atoms(spark, sf_dir).withColumn("id", fixtures.structure_id())


def _n_files(spark):
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def _score_structures_array(structures):
    s = structure.add_score(structure.structure_metrics_array(structures), CFG)
    return structure.rounded(s, SCORED).select(
        "id", "n_res", "net_charge", "muH", "plddt", "dist_nc", "score")


@query
def pdb_roundtrip(spark, sf_dir):
    """S3: structures rendered as PDB text, parsed back (array form) and
    scored without any shuffle."""
    from seqscore.sinks.files import write_pdb
    from seqscore.sources.files import read_pdb
    path = write_pdb(_pdb_atoms(spark, sf_dir), _scratch(spark, "pdb"), _n_files(spark),
                     order_col="ord_key")
    return _score_structures_array(read_pdb(spark, path))


@query
def file_inventory(spark, sf_dir):
    """PDB files in the preferred folder, discovered with the
    fallback rule, listed without reading contents, and every structure in a
    non-empty listed file recovered."""
    from seqscore.sinks.files import write_pdb
    from seqscore.sources.files import discover, read_pdb, structure_inventory
    root = _scratch(spark, "pdb_folders")
    write_pdb(_pdb_atoms(spark, sf_dir), f"{root}/prediction_results", _n_files(spark), order_col="ord_key")
    where = discover(spark, f"{root}/prediction_results", root, "*.txt")
    inv = structure_inventory(spark, where, "*.txt").filter(F.col("length") > 0)
    return read_pdb(spark, where, "*.txt").join(inv.select("path"), "path", "left_semi").select("id")


@query
def legacy_positions(spark, sf_dir):
    """Ids from the stems of one file name per structure, and the ids
    that the old naming gave by the files' places in the order of names."""
    from seqscore.sources.files import file_stem, legacy_ids
    files = scores(spark, sf_dir).select(
        F.concat("id", F.lit(".pdb")).alias("file_name"), F.lit(0).alias("block_no"), "net_charge")
    return legacy_ids(files.withColumn("id", file_stem(F.col("file_name")))).select("id", "legacy_id", "net_charge")


@query
def stream_score(spark, sf_dir):
    """PDB files scored by a Structured Streaming query (file source,
    checkpointed, availableNow) into Parquet."""
    from seqscore.sinks.files import write_pdb
    from seqscore.streaming.incremental import read_scored, run_incremental
    src = write_pdb(_pdb_atoms(spark, sf_dir), _scratch(spark, "stream_in"), _n_files(spark),
                    order_col="ord_key")
    out, ckpt = _scratch(spark, "stream_out"), _scratch(spark, "stream_ckpt")
    run_incremental(spark, src, out, ckpt, CFG)
    s = read_scored(spark, out)
    return structure.rounded(s, SCORED).select(
        "id", "n_res", "net_charge", "muH", "plddt", "dist_nc", "score")


@query
def resumed_score(spark, sf_dir):
    """Half of the structures are written as PDB files and scored, then the
    others are added to the folder; the second run reads only these, the third
    nothing."""
    from seqscore.plans import resume
    from seqscore.sinks.files import write_pdb
    src, out = _scratch(spark, "resume_in"), _scratch(spark, "resume_out")
    atoms = _pdb_atoms(spark, sf_dir)
    half = F.col("seq_idx") % 2 == 0
    for part in (half, ~half):
        write_pdb(atoms.filter(part), src, _n_files(spark), order_col="ord_key", mode="append")
        resume.score_new(spark, src, out, CFG, glob="*.txt")
    again = resume.score_new(spark, src, out, CFG, glob="*.txt")
    if again.files_read:
        raise AssertionError(f"the third run read {again.files_read} files")
    return structure.rounded(resume.scored(spark, out), SCORED).select(
        "id", "n_res", "net_charge", "muH", "plddt", "dist_nc", "score")


def relaxation_ratio(rows):
    """Example function for the guarded map: relative energy change of a batch;
    raises where a run failed (missing energies) or started at zero."""
    e0, e1 = rows["e_initial"], rows["e_final"]
    if (e0 != e0).any() or (e1 != e1).any():
        raise ValueError("energy missing")
    if (e0 == 0).any():
        raise ZeroDivisionError("float division by zero")
    return {"ratio": (e1 - e0) / abs(e0)}


@query
def guarded_map(spark, sf_dir):
    """A Python function over Arrow batches, halved around failing rows;
    these become NULL records with the error text instead of failing the job."""
    from seqscore.runtime import guarded_map as gmap
    e = fixtures.energies(spark, sf_dir, scores(spark, sf_dir)).select("id", "e_initial", "e_final")
    out = gmap(e, relaxation_ratio, "id STRING, ratio DOUBLE, error STRING", ["id"])
    return out.select("id", round_dp(F.col("ratio"), 6).alias("ratio"), "error")


def helical_moment(rows):
    """Hydrophobic moment of a batch of sequences wound as a helix (100 degrees
    a residue): the length of the sum of the residues' scale values as vectors,
    by one running sum over all residues of the batch."""
    import numpy as np
    seqs = list(rows["sequence"])
    if any(s is None or len(s) < 2 for s in seqs):
        raise ValueError("sequence too short")
    value = np.zeros(256)
    for name, residue in zip(C.THREE_LETTER, C.AMINO_ACIDS, strict=True):
        value[ord(residue)] = C.EISENBERG[name]
    size = np.array([len(s) for s in seqs])
    ends = np.cumsum(size)
    h = value[np.frombuffer("".join(seqs).encode(), np.uint8)]
    turn = np.radians(100.0) * (np.arange(len(h)) - np.repeat(ends - size, size))
    parts = [np.add.reduceat(h * f(turn), ends - size) for f in (np.cos, np.sin)]
    return {"moment": np.hypot(*parts) / size}


@query
def guarded_moment(spark, sf_dir):
    """U3 over every document's sequence with a numpy function that works on
    the residues of a whole batch at once."""
    from seqscore.runtime import guarded_map as gmap
    out = gmap(_peptides(spark, sf_dir).select("id", "sequence"), helical_moment,
               "id STRING, moment DOUBLE, error STRING", ["id"])
    return out.select("id", round_dp(F.col("moment"), 6).alias("moment"), "error")


# -- SQL access ------------------------------------------------------------------

def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register the fixture views and derived tables as Spark temp views
    (``ca_atoms``, ``peptides``, ``scores``, ``ranked``, ``energies``) so
    they can be queried with ``spark.sql``.  The frames are lazy except for
    the pinned rank."""
    views = {
        "ca_atoms": fixtures.ca_atoms(spark, sf_dir),
        "peptides": _peptides(spark, sf_dir),
        "scores": scores(spark, sf_dir),
    }
    views["ranked"] = ranking.global_rank(views["scores"], by_score())
    views["energies"] = fixtures.energies(spark, sf_dir, views["scores"])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
