"""Token ids as binary shards with Elias-Fano document boundaries (op 8).

A shard is one immutable file::

    magic 8 bytes | header (fixed little-endian struct)
    document ids   Elias-Fano over (doc_id - smallest)
    boundaries     Elias-Fano over the end offsets of the documents
    token ids      concatenated, 2 or 4 bytes each
    one line feed

A non-decreasing sequence of n values below u is kept in n low parts of
l = floor(log2(u / n)) bits and a bit vector of n + (u >> l) + 1 bits in
which bit ``(x >> l) + i`` is set for the i-th value, about 2 + log2(u / n)
bits a value.  A sample of every 256th set bit serves ``select``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import RangeReader, blob_files, scratch_path, write_blobs
from .tokenizing import TextEncoder, blocks, default_vocabulary

MAGIC = b"EFTOKS1\0"
# part, shard, documents, of them without an id, ids, bytes an id, smallest doc_id
HEADER = struct.Struct("<qqqqqqq")
SAMPLE = 256
# A shard is closed once it holds this many ids (a longer document fills one
# alone); it bounds a task's memory, not what is stored.
IDS_PER_SHARD = 16_000_000


class EliasFano:
    """Static non-decreasing sequence with random access."""

    _HEAD = struct.Struct("<qqqq")  # values, universe, low bits, samples

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: bytes,
                 samples: np.ndarray):
        self.n, self.universe, self.low_bits = n, universe, low_bits
        self._low, self._high, self._samples = low, high, samples

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        x = np.asarray(values, np.uint64)
        n = len(x)
        if n == 0:
            return cls(0, universe, 0, b"", b"", np.zeros(0, "<u4"))
        bits = max(0, int(max(universe, 1) // n).bit_length() - 1)
        if bits:
            weights = np.arange(bits, dtype=np.uint64)
            low = np.packbits(((x[:, None] >> weights) & np.uint64(1)).astype(np.uint8),
                              bitorder="little").tobytes()
        else:
            low = b""
        at = (x >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(universe) >> bits) + n + 1, np.uint8)
        high[at] = 1
        return cls(n, universe, bits, low, np.packbits(high, bitorder="little").tobytes(),
                   at[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return (self._HEAD.pack(self.n, self.universe, self.low_bits, len(self._samples))
                + struct.pack("<qq", len(self._low), len(self._high))
                + self._low + self._high + self._samples.tobytes())

    @classmethod
    def from_bytes(cls, raw: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, universe, bits, k = cls._HEAD.unpack_from(raw, at)
        a, b = struct.unpack_from("<qq", raw, at + cls._HEAD.size)
        p = at + cls._HEAD.size + 16
        samples = np.frombuffer(raw, "<u4", k, p + a + b)
        end = p + a + b + 4 * k
        return cls(n, universe, bits, raw[p:p + a], raw[p + a:p + a + b], samples), end

    def _low_part(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        word = int.from_bytes(self._low[first // 8:(first + self.low_bits + 7) // 8], "little")
        return (word >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        bit, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        while True:
            byte = bit // 8
            word = np.unpackbits(np.frombuffer(self._high[byte:byte + 64], np.uint8),
                                 bitorder="little")
            word[:bit - 8 * byte] = 0
            ones = np.flatnonzero(word)
            if left < len(ones):
                bit = 8 * byte + int(ones[left])
                return ((bit - i) << self.low_bits) | self._low_part(i)
            left -= len(ones)
            bit = 8 * byte + 8 * 64

    def values(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self._high, np.uint8),
                                            bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self._low, np.uint8), bitorder="little",
                                 count=self.n * self.low_bits).reshape(self.n, self.low_bits)
            high |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)
                     ).sum(axis=1, dtype=np.uint64)
        return high.astype(np.int64)


def encode_shard(part: int, shard: int, doc_ids: list[int | None], ids: list[bytes],
                 id_bytes: int) -> bytes:
    """One shard; ``ids`` are the documents' ids as unsigned 32-bit bytes,
    documents without an id come first."""
    nulls = sum(d is None for d in doc_ids)
    known = np.asarray([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(b) // 4 for b in ids], dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    gaps = known.astype(object) - base if len(known) else known
    span = int(gaps[-1]) + 1 if len(known) else 1
    body = np.frombuffer(b"".join(ids), "<u4")
    if id_bytes == 2:
        body = body.astype("<u2")
    return (MAGIC + HEADER.pack(part, shard, len(doc_ids), nulls, total, id_bytes, base)
            + EliasFano.build(np.asarray(gaps, np.uint64), span).to_bytes()
            + EliasFano.build(ends, total + 1).to_bytes() + body.tobytes())


def read_header(reader: RangeReader) -> tuple[int, ...]:
    raw = reader.read_at(0, len(MAGIC) + HEADER.size)
    if raw[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    return HEADER.unpack_from(raw, len(MAGIC))


class TokenShard:
    """A shard opened for reading: boundaries in memory, ids by byte range."""

    def __init__(self, reader: RangeReader):
        (self.part, self.shard, self.n_docs, self.n_null, self.n_ids, self.id_bytes,
         self.base) = read_header(reader)
        self._reader = reader
        head = len(MAGIC) + HEADER.size
        self._ids_at = reader.size - 1 - self.n_ids * self.id_bytes
        raw = reader.read_at(head, self._ids_at - head)
        self._docs, at = EliasFano.from_bytes(raw)
        self._ends, _ = EliasFano.from_bytes(raw, at)

    def bounds(self, i: int) -> tuple[int, int]:
        """Start and end of the i-th document among the shard's ids."""
        return (self._ends.select(i - 1) if i else 0), self._ends.select(i)

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self._reader.read_at(self._ids_at + start * self.id_bytes,
                                   (end - start) * self.id_bytes)
        return np.frombuffer(raw, f"<u{self.id_bytes}").astype("<u4")

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self._docs.values() + self.base).tolist()

    def ends(self) -> np.ndarray:
        return self._ends.values()


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str | None = None, end_id: int = 0,
                      ids_per_shard: int = IDS_PER_SHARD, partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write shards in ascending
    document order (documents without an id first, rows that repeat an id in
    order of their text).  A null text is empty: its ids are the end id alone.

    One range shuffle of the texts; tokenization follows it, so that finding
    the ranges costs a scan and no encoding."""
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .repartitionByRange(n, "id").sortWithinPartitions("id", "text")
            .select(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("id"), "text"))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = TextEncoder.of(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        part, shard, held = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        for f in frames:
            keys = [None if no else k for no, k in zip(f["no_id"].tolist(), f["id"].tolist(), strict=True)]
            texts = f["text"].tolist()
            for at, to in blocks(texts):
                for k, raw in zip(keys[at:to],
                                  enc.encode(texts[at:to]), strict=True):
                    raw += end
                    if ids and held + len(raw) // 4 > ids_per_shard:
                        yield pd.DataFrame({"shard": [encode_shard(part, shard, doc_ids, ids,
                                                                   enc.id_bytes)]})
                        shard, held, doc_ids, ids = shard + 1, 0, [], []
                    doc_ids.append(k)
                    ids.append(raw)
                    held += len(raw) // 4
        if ids:
            yield pd.DataFrame({"shard": [encode_shard(part, shard, doc_ids, ids, enc.id_bytes)]})

    write_blobs(rows.mapInPandas(encode, "shard binary"), "shard", path)


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """(path, first) of every shard: the number of ids in all shards before it.

    Reads the headers alone; the running sum covers one row a file."""
    def heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for p in f["path"]:
                with RangeReader(p) as r:
                    part, shard, _, _, n_ids, _, _ = read_header(r)
                rows.append((p, part, shard, n_ids))
            yield pd.DataFrame(rows, columns=["path", "part", "shard", "n_ids"])

    files = blob_files(spark, path).select("path")
    heads_df = files.mapInPandas(heads, "path string, part long, shard long, n_ids long")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return heads_df.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards."""
    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, first in zip(f["path"], f["first"], strict=True):
                with RangeReader(p) as r:
                    shard = TokenShard(r)
                    ends = shard.ends()
                    starts = np.concatenate([[0], ends[:-1]])
                    crc, at = np.zeros(len(ends), np.int64), 0
                    while at < len(ends):  # some megabytes of ids at a time
                        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 2_000_000)))
                        ids = shard.ids(int(starts[at]), int(ends[to - 1])).tobytes()
                        for i in range(at, to):
                            a, b = 4 * int(starts[i] - starts[at]), 4 * int(ends[i] - starts[at])
                            crc[i] = zlib.crc32(ids[a:b])
                        at = to
                    yield pd.DataFrame({"doc_id": pd.array(shard.doc_ids(), "Int64"),
                                        "start": starts + first, "n_tokens": ends - starts,
                                        "ids_crc32": crc})

    index = shard_index(spark, path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (index.repartition(n, "path")
            .mapInPandas(documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_file_round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the shards (below ``path``, or a new shared folder) and read them back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, **options)
    return read_token_files(spark, path)
