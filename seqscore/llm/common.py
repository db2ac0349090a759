"""Helpers shared by the operators of this package: files in the shared
folder, byte-range reads, held-out folds."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore.session import cut_lineage, scratch_path

__all__ = ["cut_lineage", "scratch_path", "write_blobs", "blob_files", "RangeReader",
           "fold", "free_name", "free_prefix", "give_back"]


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def free_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, with underscores in front until no column starts with it."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix = "_" + prefix
    return prefix


def give_back() -> None:
    """Return memory that a finished task no longer needs to the system: Python
    workers outlive their tasks, and the next stage needs the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % F.lit(n)


def write_blobs(df: DataFrame, blob: str, path: str) -> None:
    """Write each row's binary column as a file of its own below ``path``.

    The rows go through Spark's own text sink, so that files appear by its
    commit protocol on whatever store ``path`` names and a repeated task
    leaves no half file.  The sink ends every file with one line feed; the
    formats written here allow for that byte."""
    (df.select(F.col(blob).cast("string").alias("value")).write
       .option("maxRecordsPerFile", 1).option("lineSep", "\n").option("compression", "none")
       .mode("error").text(path))


def blob_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below ``path``; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
            .load(path).select("path", "length"))


class RangeReader:
    """Reads byte ranges of one file by its URI, without loading the file."""

    def __init__(self, uri: str):
        if uri.startswith("file:/") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()

    def read_at(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"range {offset}+{length} outside a file of {self.size} bytes")
        return self.file.read_at(length, offset) if length else b""

    def close(self) -> None:
        self.file.close()

    def __enter__(self) -> RangeReader:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
