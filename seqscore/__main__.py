"""Command line: ``python -m seqscore <stage> [options]`` (one stage per call)."""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="seqscore")
    ap.add_argument("--master", default=None, help="Spark master (default: the session's)")
    sub = ap.add_subparsers(dest="stage", required=True)
    s = sub.add_parser("ingest"); s.add_argument("input_csv"); s.add_argument("out_dir")
    s.add_argument("--weights", default=None, help="CSV with dipeptide,weight; without it the instability index is empty")
    s = sub.add_parser("fasta"); s.add_argument("sequences_csv"); s.add_argument("out_dir")
    s.add_argument("--limit", type=int, default=0)
    s = sub.add_parser("score"); s.add_argument("pdb_dir"); s.add_argument("out_dir")
    s.add_argument("--config", default=None, help="scoring config JSON (else $SCORING_CONFIG)")
    s.add_argument("--plddt-scale", type=float, default=1.0)
    s.add_argument("--on-empty", choices=("write", "raise"), default="write")
    s.add_argument("--resume-from", default=None, help="folder that keeps what is scored; only new files are read")
    s = sub.add_parser("triplets"); s.add_argument("preferences"); s.add_argument("sequences_csv")
    s.add_argument("out_dir")
    s = sub.add_parser("generated"); s.add_argument("generated_csv"); s.add_argument("pdb_dir")
    s.add_argument("out_dir"); s.add_argument("--config", default=None)
    s = sub.add_parser("clean"); s.add_argument("generated_csv"); s.add_argument("out_dir")
    s = sub.add_parser("validate"); s.add_argument("scored_csv"); s.add_argument("energies_csv")
    s.add_argument("pdb_dir"); s.add_argument("out_dir")
    s.add_argument("--relaxed-dir", default=None, help="folder of <id>_relaxed.pdb files")
    s.add_argument("--top-n", type=int, default=None, help="default: $TOP_N or 10")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from seqscore.config import env_int, load_config
    from seqscore.plans import stages
    from seqscore.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.appName(f"seqscore-{a.stage}")
    if a.master:
        b = b.master(a.master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.stage == "ingest":
        weights = None
        if a.weights:
            from seqscore.sources.files import read_csv
            weights = read_csv(spark, a.weights, "dipeptide STRING, weight DOUBLE")
        stages.ingest(spark, a.input_csv, a.out_dir, weights=weights)
    elif a.stage == "fasta":
        stages.prepare_fasta(spark, a.sequences_csv, a.out_dir, a.limit)
    elif a.stage == "score":
        stages.score_and_pair(spark, a.pdb_dir, a.out_dir, load_config(a.config),
                              plddt_scale=a.plddt_scale, on_empty=a.on_empty, resume_from=a.resume_from)
    elif a.stage == "triplets":
        stages.build_triplets(spark, a.preferences, a.sequences_csv, a.out_dir)
    elif a.stage == "generated":
        stages.score_generated(spark, a.generated_csv, a.pdb_dir, a.out_dir,
                               load_config(a.config, on_bad_json="default"))
    elif a.stage == "clean":
        stages.clean_generated_csv(spark, a.generated_csv, a.out_dir)
    elif a.stage == "validate":
        top_n = a.top_n if a.top_n is not None else env_int("TOP_N", 10)
        stages.validate(spark, a.scored_csv, a.energies_csv, a.pdb_dir, a.out_dir, top_n, a.relaxed_dir)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
