"""Small fixed lookup tables as DataFrames (J7).  Their size is fixed by
the constants, so broadcasting them is always safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqscore import constants as C


def scale_table(spark: SparkSession, scale: dict = C.EISENBERG) -> DataFrame:
    """(resname, h): the hydrophobicity scale, one row per residue."""
    return spark.createDataFrame(sorted(scale.items()), "resname string, h double")
