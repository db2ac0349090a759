"""Session helpers: building a local session for tests/bench, and
reliable lineage cuts into the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cluster-sized defaults; tests and bench override partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # pinned copies (reliable checkpoints) are deleted once the DataFrames
    # that use them are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Scalar-subquery results and P-row partition summaries are the only
    # things broadcast explicitly; keep the automatic threshold at its
    # default so large dimension tables are never auto-broadcast by surprise.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "seqscore",
                  extra_conf: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.default.parallelism", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured ``spark.checkpoint.dir``.  Where it is unset, a
    local session gets a fresh scratch folder; on a cluster, whose hosts share
    no local folder, that is an error."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or None
    if d is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: on {master}, name a folder that all hosts share")
        d = tempfile.mkdtemp(prefix="seqscore-ckpt-", dir=os.environ.get("SEQSCORE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan derives both a per-partition summary and per-row
    values from one range-partitioned relation: the checkpoint pins the
    partition assignment so a lost executor cannot make them disagree.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def computed_once(df: DataFrame, col: str) -> DataFrame:
    """The frame with ``col`` behind a generator of one element: the optimizer
    would copy the whole expression into every filter on the column that it
    pushes down, and there evaluate it for each mention."""
    return df.withColumn(col, F.explode(F.array(col)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh output folder under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
