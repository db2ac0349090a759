"""A scoring stage that resumes.

What has been done is kept in a ledger beside the results: path, length and
modification time of every input file, and the number of the batch that read
it.  A run compares it with the inventory of the input folder and reads only
files that are new or have changed.  Results go to ``scores/batch=<n>``, the
files of the batch to ``ledger/batch=<n>`` behind them; a run that dies between
leaves no ledger entry, and the next one writes the same batch again.

The current results are those of every file's latest batch, so a changed file
replaces what it gave before.  Only file names and batch numbers are compared;
file lists are split into batches, and a batch's list is what the driver holds
(as Spark's own file index does).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore.config import ScoringConfig
from seqscore.operators import structure
from seqscore.runtime import path_exists
from seqscore.sources import files as sources

FILES_PER_BATCH = 20_000
LEDGER = "path STRING, length BIGINT, modified TIMESTAMP, batch INT"
METRICS = ["n_res", "net_charge", "muH", "plddt", "dist_nc", "score", "cyclic_candidate"]
SCORES = ("path STRING, id STRING, n_res BIGINT, net_charge DOUBLE, muH DOUBLE, plddt DOUBLE, dist_nc DOUBLE, "
          "score DOUBLE, cyclic_candidate BOOLEAN, batch INT")


@dataclass(frozen=True)
class Run:
    """What a run did: batches written, files read, files left as they were."""

    batches: int
    files_read: int
    files_skipped: int


class Ledger:
    """Files that a stage has processed, in ``<folder>/ledger``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def latest(self) -> DataFrame:
        """path, length, modified, batch of every file's last processing."""
        last = F.max_by(F.struct("length", "modified", "batch"), F.col("batch")).alias("_e")
        return self._read("ledger", LEDGER).groupBy("path").agg(last).select("path", "_e.*")

    def next_batch(self) -> int:
        n = self._read("ledger", LEDGER).agg(F.max("batch")).first()[0]
        return 0 if n is None else n + 1

    def pending(self, inventory: DataFrame) -> DataFrame:
        """Files of the inventory that no batch has read as they are now."""
        same = ["path", "length", "modified"]
        return inventory.join(self.latest().select(*same), same, "left_anti")

    def write(self, name: str, df: DataFrame, batch: int) -> None:
        """A batch's rows; those of an earlier try are replaced."""
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch}")

    def current(self, name: str, schema: str) -> DataFrame:
        """The rows of every file's latest batch."""
        rows = self._read(name, schema)
        return rows.join(self.latest().select("path", "batch"), ["path", "batch"], "left_semi").drop("batch")


def score_new(spark: SparkSession, pdb_dir: str, out_dir: str, cfg: ScoringConfig | None = None,
              glob: str = "*.pdb", plddt_scale: float = 1.0, files_per_batch: int = FILES_PER_BATCH) -> Run:
    """Score the structures of all files of ``pdb_dir`` that ``out_dir`` does
    not hold yet, or holds in another state.  A file without structures counts
    as done; files that are gone keep their results."""
    cfg = cfg or ScoringConfig()
    ledger = Ledger(spark, out_dir)
    inventory = sources.structure_inventory(spark, pdb_dir, glob).select("path", "length", "modified")
    total = inventory.count()
    todo = ledger.pending(inventory).orderBy("path").limit(files_per_batch)
    batches = read = 0
    while files := todo.collect():
        batch = ledger.next_batch()
        structures = sources.read_pdb(spark, [f.path for f in files], glob)
        if plddt_scale != 1.0:
            structures = structure.scaled_plddt(structures, plddt_scale)
        scored = structure.add_score(structure.structure_metrics_array(structures), cfg)
        ledger.write("scores", scored.select("path", "id", *METRICS), batch)
        ledger.write("ledger", spark.createDataFrame(files, inventory.schema), batch)
        batches, read = batches + 1, read + len(files)
        todo = ledger.pending(inventory).orderBy("path").limit(files_per_batch)
    return Run(batches, read, total - read)


def scored(spark: SparkSession, out_dir: str) -> DataFrame:
    """path, id and metrics of all structures scored so far."""
    return Ledger(spark, out_dir).current("scores", SCORES)
