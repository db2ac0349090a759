"""Corpus pipeline: toxicity, quality, near duplicates, mixing, packing.

Each stage works on all rows that its predecessor kept and returns the columns
of ``documents``, the last one the packed pieces.  Decisions take effect:
rejected documents go, one document of each near-duplicate group stays, and
documents are sampled with their calibrated probabilities.

Stages judge texts by the labels and texts they are given: a null text is
empty, which the quality stage rejects.  ``documents`` may have further
columns; they pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore.llm import packing, quality, raking, simhash, toxicity
from seqscore.llm.common import free_prefix, scratch_path
from seqscore.sources.tables import read_table

TOXIC_FROM = 0.7
# Trusted documents decide the quality threshold: beyond this quantile of theirs, times the margin.
QUALITY_QUANTILE, QUALITY_MARGIN = 0.998, 1.2
WORDS_PER_SHINGLE, MAX_DISTANCE = 3, 2
MIX_EXPONENT, MIX_FRACTION = 0.7, 0.6
SEQUENCE_TOKENS = 1024


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC_FROM``."""
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return docs.filter(toxicity.score(spark, model, F.col("text")) < TOXIC_FROM)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's quantile."""
    return quality.keep_within(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]),
                               quantile=QUALITY_QUANTILE, margin=QUALITY_MARGIN)


def keep_first_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id."""
    return simhash.keep_first(docs, words_per_shingle=WORDS_PER_SHINGLE, max_distance=MAX_DISTANCE, repeats=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with source, language and topic shares raked to their targets."""
    p = free_prefix(docs.columns, "__mix_")
    mixed = raking.mix(docs, exponent=MIX_EXPONENT, fraction=MIX_FRACTION, prefix=p)
    return mixed.filter(f"{p}sampled = 1").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack_documents(docs, capacity=SEQUENCE_TOKENS)


STAGES = [("toxicity", keep_civil), ("quality", keep_good), ("near_duplicates", keep_first_of_group),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# Fitted models, hashes and tokenizers have no form in SQL: tests compare the
# stages with plain versions of them.
ORACLE_SQL = None


# Row groups of whole texts are held in memory until they are full.
ROW_GROUP_BYTES = 32 << 20


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written to the shared
    folder and read again, so a lost executor costs no earlier stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.option("parquet.block.size", ROW_GROUP_BYTES).mode("error").parquet(path)
        docs = spark.read.parquet(path)
    return docs
