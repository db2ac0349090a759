"""File-in / file-out entry points matching the source workflow's stages.

Each stage is a composition of the operators (no logic of its own beyond
wiring), reads its inputs with explicit schemas and writes CSV / JSON
lines / JSON / FASTA outputs into a folder.  They can be chained exactly
like the original stages (ingest -> FASTA -> structures scored and paired
-> triplets -> generated set scored -> validation), and run from the
command line: ``python -m seqscore <stage> ...``.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.config import ScoringConfig
from seqscore.functions import sequence as S
from seqscore.functions.numeric import score_key
from seqscore.operators import pairs, ranking, reports, structure, validation
from seqscore.operators.descriptors import descriptors
from seqscore.plans import resume
from seqscore.runtime import require_non_empty
from seqscore.session import cut_lineage
from seqscore.sinks import files as sinks
from seqscore.sources import files as sources

LOG = logging.getLogger("seqscore.stages")

SCORE_COLUMNS = ["id", "net_charge", "muH", "plddt", "dist_nc", "score"]
SCORED_GENERATED = ["id", "sequence", "net_charge", "muH", "plddt", "dist_nc", "score",
                    "cyclic_candidate", "cys_count", "rank"]


def _out(folder: str, name: str) -> str:
    return os.path.join(folder, name) if "://" not in folder else f"{folder.rstrip('/')}/{name}"


def load_sequences(spark: SparkSession, csv_path: str, schema: str = sources.SEQUENCE_SCHEMA) -> DataFrame:
    """S1 + P1 + P4: sequences normalised, with ``seq_idx``/``id`` by file position."""
    df = sources.read_sequences_csv(spark, csv_path, schema)
    df = sources.assign_ids(df)
    return df.withColumn("sequence", S.normalize_sequence(F.col("sequence")))


def split_rejected(seqs: DataFrame, out_dir: str, name: str) -> DataFrame:
    """Rows whose normalised sequence is NULL or empty are not turned
    into text; they go to a side table ``<name>_rejected`` (seq_idx, id,
    reason) and the valid rows are returned.  The seqs frame is pinned so
    both outputs read one copy."""
    seqs = cut_lineage(seqs)
    bad = F.col("sequence").isNull() | (F.length("sequence") == 0)
    rejected = seqs.filter(bad).select(
        "seq_idx", "id",
        F.when(F.col("sequence").isNull(), F.lit("null sequence")).otherwise(F.lit("empty sequence"))
        .alias("reason"))
    counted, obs = sinks.counted(rejected, name + "_rejected")
    sinks.write_csv(counted, _out(out_dir, name + "_rejected"))
    if obs.get["rows"]:
        LOG.warning("%s: %d rows without a sequence rejected", name, obs.get["rows"])
    return seqs.filter(~bad)


def ingest(spark: SparkSession, input_csv: str, out_dir: str, schema: str = sources.SEQUENCE_SCHEMA,
           weights: DataFrame | None = None) -> DataFrame:
    """Stage 1: descriptors appended to every input row (passthrough kept)."""
    seqs = split_rejected(load_sequences(spark, input_csv, schema), out_dir, "ingest")
    d = descriptors(seqs, weights)
    cols = [c for c in seqs.columns if c not in ("seq_idx", "id")] + [
        "hydrophobicity", "charge", "instability_index", "isoelectric_point"]
    out = d.orderBy("seq_idx").select(*cols)
    counted, obs = sinks.counted(out, "ingest")
    sinks.write_csv(counted, _out(out_dir, "ingested_sequences"))
    LOG.info("ingest: %d sequences with descriptors written", obs.get["rows"])
    return out


def prepare_fasta(spark: SparkSession, sequences_csv: str, out_dir: str, limit: int = 0) -> DataFrame:
    """Stage 2 input: one FASTA record per sequence (P3 first-n with limit > 0)."""
    seqs = load_sequences(spark, sequences_csv, "sequence STRING")
    if limit > 0:
        seqs = seqs.filter(F.col("seq_idx") < limit)
    seqs = split_rejected(seqs, out_dir, "fasta")
    counted, obs = sinks.counted(seqs, "fasta")
    sinks.write_fasta(counted, _out(out_dir, "fasta_inputs"))
    LOG.info("fasta: %d records written", obs.get["rows"])
    return seqs


def _structures(spark: SparkSession, pdb_dir: str) -> DataFrame | None:
    where = sources.discover(spark, _out(pdb_dir, "prediction_results"), pdb_dir, "*.pdb")
    return None if where is None else sources.read_pdb(spark, where, "*.pdb")


def score_structures(spark: SparkSession, pdb_dir: str, cfg: ScoringConfig,
                     plddt_scale: float = 1.0) -> DataFrame:
    """S3 + array-form metrics + P11 (no shuffle: one row per structure)."""
    st = _structures(spark, pdb_dir)
    if st is None:
        schema = "id string, net_charge double, muH double, plddt double, dist_nc double, score double"
        return spark.createDataFrame([], schema)
    if plddt_scale != 1.0:
        st = structure.scaled_plddt(st, plddt_scale)
    m = structure.add_score(structure.structure_metrics_array(st), cfg)
    return m.select(*SCORE_COLUMNS, "cyclic_candidate")


def score_and_pair(spark: SparkSession, pdb_dir: str, out_dir: str, cfg: ScoringConfig | None = None,
                   fraction: float = C.WINNER_FRACTION, plddt_scale: float = 1.0,
                   on_empty: str = "write", resume_from: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage 3: scoring_results.csv and preferences.jsonl (nearest loser), and
    side tables of the structures that can't be scored.  Without any scored
    structure the tables are empty (``on_empty="write"``) or it fails.

    With ``resume_from``, a folder that outlives the run, only files that are
    new or changed since the last run with it are read and scored; ranks and
    pairs are made from all structures scored so far, and the side tables are
    left to full runs."""
    cfg = cfg or ScoringConfig()
    structures = None if resume_from else _structures(spark, pdb_dir)
    if structures is not None:
        # Ids that hold no CA record or lack a coordinate are listed, not scored
        sinks.write_csv(sources.without_ca(structures), _out(out_dir, "structures_without_ca"))
        sinks.write_csv(structure.incomplete_structures_array(structures).filter("n_missing > 0"),
                        _out(out_dir, "structures_incomplete"))
    if resume_from:
        where = sources.discover(spark, _out(pdb_dir, "prediction_results"), pdb_dir, "*.pdb")
        if where is not None:
            run = resume.score_new(spark, where, resume_from, cfg, "*.pdb", plddt_scale)
            LOG.info("score: %d files read, %d left as they were", run.files_read, run.files_skipped)
        scored = resume.scored(spark, resume_from).select(*SCORE_COLUMNS, "cyclic_candidate")
    else:
        scored = score_structures(spark, pdb_dir, cfg, plddt_scale)
    scored = cut_lineage(scored)
    if on_empty == "raise":
        require_non_empty(scored, "scored structures")
    s_counted, s_obs = sinks.counted(scored.select(*SCORE_COLUMNS), "scored")
    sinks.write_csv(s_counted, _out(out_dir, "scoring_results"))
    keyed = scored.withColumn("_k", F.col("id"))
    ranked = ranking.global_rank(keyed, [score_key("score").desc_nulls_last(), F.col("_k")])
    prefs = pairs.preference_pairs(ranked, fraction)
    p_counted, p_obs = sinks.counted(prefs, "pairs")
    sinks.write_jsonl(p_counted, _out(out_dir, "preferences"))
    LOG.info("score: %d structures scored, %d preference pairs", s_obs.get["rows"], p_obs.get["rows"])
    return scored, prefs


def build_triplets(spark: SparkSession, preferences: str, sequences_csv: str, out_dir: str,
                   on_missing: str = "raise") -> DataFrame:
    """Stage 4 input: (prompt, chosen, rejected) sequences as JSON lines."""
    prefs = sources.read_pairs(spark, preferences)
    seqs = load_sequences(spark, sequences_csv, "sequence STRING")
    t = pairs.training_triplets(prefs, seqs, on_missing).select("prompt", "chosen", "rejected")
    counted, obs = sinks.counted(t, "triplets")
    sinks.write_jsonl(counted, _out(out_dir, "dpo_triplets"))
    LOG.info("triplets: %d written", obs.get["rows"])
    return t


def clean_generated_csv(spark: SparkSession, generated_csv: str, out_dir: str) -> DataFrame:
    """Stage 4 output cleaning (P18) for raw sampled text."""
    df = sources.read_sequences_csv(spark, generated_csv).select(
        S.clean_generated(F.col("sequence")).alias("sequence"))
    sinks.write_csv(df, _out(out_dir, "optimized_sequences"))
    return df


def score_generated(spark: SparkSession, generated_csv: str, pdb_dir: str, out_dir: str,
                    cfg: ScoringConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage 5: scored_generated.csv (sequence by index, Cys count, rank)
    and the batch summary; fails when no structure could be scored (P21)."""
    cfg = cfg or ScoringConfig()
    scored = require_non_empty(score_structures(spark, pdb_dir, cfg), "scored structures")
    seqs = load_sequences(spark, generated_csv, "sequence STRING").select("seq_idx", "sequence")
    j = (scored.withColumn("seq_idx", S.parse_id(F.col("id")))
         .join(seqs, "seq_idx", "left")
         .withColumn("sequence", F.coalesce(F.col("sequence"), F.lit("")))
         .withColumn("cys_count", S.cys_count(F.col("sequence")))
         .withColumn("_k", F.col("id")))
    ranked = ranking.global_rank(j, [score_key("score").desc_nulls_last(), F.col("_k")])
    table = ranked.select(*[c for c in SCORED_GENERATED if c in ranked.columns])
    counted, obs = sinks.counted(table.orderBy("rank"), "scored_generated")
    sinks.write_csv(counted, _out(out_dir, "scored_generated"))
    LOG.info("generated: %d structures scored and ranked", obs.get["rows"])
    summary = reports.batch_summary(table)
    sinks.write_json_summary(summary, _out(out_dir, "generated_summary"))
    return table, summary


def _displacements(spark: SparkSession, cand: DataFrame, pdb_dir: str, relaxed_dir: str | None) -> DataFrame:
    """(id, rmsd, n_atoms, relaxed_pdb, error) of the candidates that have a
    relaxed structure, over all their atoms; no rows without a folder of them."""
    if relaxed_dir is None:
        return spark.createDataFrame([], "id string, rmsd double, n_atoms bigint, relaxed_pdb string, error string")
    stem = F.regexp_replace("file_name", r"(_relaxed)?\.[^.]*$", "")
    wanted = cand.select("id").distinct()
    after = (sources.read_pdb(spark, relaxed_dir, "*_relaxed.pdb", all_atoms=True).withColumn("id", stem)
             .join(wanted, "id", "left_semi"))
    before = (sources.read_pdb(spark, pdb_dir, "*.pdb", all_atoms=True).withColumn("id", stem)
              .join(after.select("id"), "id", "left_semi"))
    moved = validation.displacement(sources.explode_all_atoms(before), sources.explode_all_atoms(after))
    paths = after.groupBy("id").agg(F.min("path").alias("relaxed_pdb"))
    return moved.join(paths, "id").select("id", "rmsd", "n_atoms", "relaxed_pdb", "error")


ENERGY_SCHEMA = "id STRING, e_initial DOUBLE, e_final DOUBLE"


def validate(spark: SparkSession, scored_csv: str, energies_csv: str, pdb_dir: str, out_dir: str,
             top_n: int = C.DEFAULT_TOP_N, relaxed_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stage 6 data work: top-N by proxy score (O2) that still have a
    structure file (J5), energies joined (P20, NULL = failed run), ranks
    and rank correlation (W3, A10), physics_validation.csv and the summary
    JSON (K3).  Candidates without a structure file are listed in
    candidates_without_file.  With ``relaxed_dir`` (files <id>_relaxed.pdb),
    rmsd and n_atoms come from all atoms of the structures before and after,
    aligned by name; structures that differ keep their row, without them, and
    are listed with the reason in structures_not_aligned.  The succeeded rows
    by physics rank are the report (O4).  Fails when no candidate survives
    (P21)."""
    schema = ("id STRING, sequence STRING, net_charge DOUBLE, muH DOUBLE, plddt DOUBLE, dist_nc DOUBLE, "
              "score DOUBLE, cyclic_candidate BOOLEAN, cys_count INT, rank INT")
    scored = sources.read_csv(spark, scored_csv, schema).withColumn("seq_idx", F.col("rank").cast("bigint"))
    top = ranking.top_n(scored, [score_key("score").desc_nulls_last(), F.col("seq_idx")], top_n)
    done, left = sources.pending(top, sources.structure_inventory(spark, pdb_dir, "*.pdb"))
    sinks.write_csv(left.select("id", "rank"), _out(out_dir, "candidates_without_file"))
    cand = require_non_empty(done, "validation candidates")
    energies = sources.read_csv(spark, energies_csv, ENERGY_SCHEMA)
    rows = validation.energy_rows(cand.join(energies, "id", "left"))
    ranked = validation.rank_validation(rows.join(cand.select("id", "sequence", "cys_count"), "id"))
    moved = cut_lineage(_displacements(spark, cand, pdb_dir, relaxed_dir))
    sinks.write_csv(moved.filter("error is not null").select("id", "error"), _out(out_dir, "structures_not_aligned"))
    table = ranked.join(moved, "id", "left").select(
        "id", "sequence", "proxy_score", "plddt", "dist_nc", "muH", "net_charge", "cys_count", "e_initial",
        "e_final", "delta_e", "rmsd", "n_atoms", "converged", "relaxed_pdb", "rank_proxy", "rank_physics")
    counted, obs = sinks.counted(table.orderBy("rank_proxy"), "physics_validation")
    sinks.write_csv(counted, _out(out_dir, "physics_validation"))
    LOG.info("validate: %d candidates written", obs.get["rows"])
    sinks.write_csv(validation.report(table).orderBy("rank_physics"), _out(out_dir, "validation_report"))
    summary = validation.validation_summary(ranked)
    sinks.write_json_summary(summary, _out(out_dir, "validation_summary"))
    return table, summary
