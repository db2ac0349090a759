"""Resumable incremental scoring with Structured Streaming.

PDB files dropped into a folder are scored as they arrive.  The file source
records every processed file in the checkpoint, so a restarted query skips
finished files (the "skip already processed" rule) and a lost executor only
replays the current micro-batch.

Files are cut into structures at their ``END`` lines while being read, so a
file of any size is split over tasks and a task holds one structure of it.
Every micro-batch is written by ``foreachBatch`` into the folder of its own
number: a batch that is replayed after a failure replaces what its first try
left, and no row appears twice.  Scoring uses the array form: stateless, no
shuffle and no watermark needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore.config import ScoringConfig
from seqscore.operators.structure import add_score, structure_metrics_array
from seqscore.sources.files import RECORD_END, parse_pdb_blocks


def scored_stream(spark: SparkSession, in_dir: str, cfg: ScoringConfig, max_files_per_trigger: int = 1000,
                  glob: str = "*", record_end: str = RECORD_END) -> DataFrame:
    """Scored structures of the files of the folder itself (not of folders
    below it), as S5 lists them."""
    files = (spark.readStream.format("text").option("lineSep", record_end)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .option("pathGlobFilter", glob).load(in_dir)
             .select("value", F.col("_metadata.file_name").alias("file_name")))
    structures = parse_pdb_blocks(files)
    return add_score(structure_metrics_array(structures), cfg).drop("atoms", "block_no")


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """Micro-batches that the query's log holds as finished: they are numbered
    from 0, so the count is the last number and one."""
    from seqscore.runtime import _hadoop_path
    fs, path = _hadoop_path(spark, f"{checkpoint.rstrip('/')}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n) + 1 for n in names if n.isdigit()), default=0)


def write_batch(out_dir: str):
    """The ``foreachBatch`` writer of ``run_incremental``."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={number}")
    return write


def run_incremental(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                    cfg: ScoringConfig | None = None, max_files_per_trigger: int = 1000, glob: str = "*",
                    record_end: str = RECORD_END) -> int:
    """Process every file not yet recorded in ``checkpoint`` and stop
    (``availableNow``); returns the number of micro-batches run."""
    cfg = cfg or ScoringConfig()
    done = _committed(spark, checkpoint)
    q = (scored_stream(spark, in_dir, cfg, max_files_per_trigger, glob, record_end).writeStream
         .foreachBatch(write_batch(out_dir)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _committed(spark, checkpoint) - done


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """All structures scored so far."""
    return spark.read.parquet(out_dir).drop("batch")
