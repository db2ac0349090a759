"""Sum-of-squares packing of documents into sequences of fixed length (op 4).

A document of more than ``capacity`` tokens is cut into full pieces, the
first of which may be shorter.  Pieces are dealt at random over packers of
about ``items_per_packer`` pieces; a packer takes its pieces by falling
length and puts each into the open sequence for which the sum over all
residual gaps of the squared number of open sequences with that gap becomes
smallest (ties: the smallest remaining gap).  A sequence is opened only when
the piece fits into none.  Only lengths are shuffled, never token ids.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .tokenizing import TextEncoder, blocks, default_vocabulary

ITEMS_PER_PACKER = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class SumOfSquares:
    """Open sequences of one packer, as counts by residual gap."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self._count = np.zeros(capacity + 1, np.int64)
        self._open: dict[int, list[int]] = defaultdict(list)

    def place(self, length: int) -> tuple[int, int]:
        """Sequence number and offset for a piece of ``length`` tokens."""
        c = self.capacity
        if not 0 < length <= c:
            raise ValueError(f"length {length} is outside 1..{c}")
        here = self._count[length:c]
        if here.any():
            # moving one sequence from gap g to g - length changes the sum by
            # 2 (n[g - length] - n[g]) + 2; a sequence that becomes full drops out
            change = 2 * (self._count[:c - length] - here) + 2
            change[0] = 1 - 2 * here[0]
            change[here == 0] = np.iinfo(np.int64).max
            left = int(change.argmin())
            gap = left + length
            seq = self._open[gap].pop()
            self._count[gap] -= 1
        else:
            gap, left = c, c - length
            seq = self.opened
            self.opened += 1
        if left:
            self._open[left].append(seq)
            self._count[left] += 1
        return seq, c - gap


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 2, capacity: int = 1024,
                 keep_ids: bool = False) -> DataFrame:
    """Token ids of every whole text and the end id, in pieces of at most
    ``capacity``.  A null or empty text gives one piece, the end id alone.
    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers
    when asked for, else null."""
    vocabulary = vocabulary or default_vocabulary()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = TextEncoder.of(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        for f in frames:
            keys = [None if no else k
                    for no, k in zip(f["no_id"].tolist(), f["id"].tolist(), strict=True)]
            texts = f["text"].tolist()
            for at, to in blocks(texts):
                rows = []
                for key, raw in zip(keys[at:to],
                                    enc.encode(texts[at:to]), strict=True):
                    raw += end
                    n = len(raw) // 4
                    stop, start, piece = n % capacity or capacity, 0, 0
                    while start < n:
                        ids = raw[4 * start:4 * stop]
                        rows.append((key, piece, start, stop - start, zlib.crc32(ids),
                                     ids if keep_ids else None))
                        start, stop, piece = stop, stop + capacity, piece + 1
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length",
                                                  "ids_crc32", "ids"])
                out["doc_id"] = pd.array(out["doc_id"].tolist(), "Int64")
                yield out

    key = F.col(id_col).cast("long")
    return docs.select(key.isNull().alias("no_id"), F.coalesce(key, F.lit(0)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = 1024, items_per_packer: int = ITEMS_PER_PACKER,
         n_pieces: int | None = None) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and
    offset.  Packers are numbered, so that sequence_id = packer * 2^32 + number.

    The number of packers follows the number of pieces: a packer's work and
    memory are bounded, and what packing apart costs (sequences left open at
    a packer's end) shrinks with the root of its pieces."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if n_pieces is None:
        n_pieces = pieces.count()
    packers = max(1, -(-n_pieces // items_per_packer))

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for f in frames:
            seq = np.empty(len(f), np.int64)
            off = np.empty(len(f), np.int64)
            for i, (p, n) in enumerate(zip(f["packer"].tolist(), f["length"].tolist(), strict=True)):
                if p != now:
                    now, state = p, SumOfSquares(capacity)
                k, off[i] = state.place(n)
                seq[i] = (p << 32) + k
            yield f[["no_id", *cols]].assign(sequence_id=seq, offset=off)

    dealt = (pieces.select(F.col("doc_id").isNull().alias("no_id"),
                           F.coalesce("doc_id", F.lit(0)).alias("doc_id"), *cols[1:], F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                         F.lit(packers)).alias("packer"))
             .repartition(packers, "packer")
             .sortWithinPartitions("packer", F.desc("length"), "doc_id", "piece", "ids_crc32"))
    placed = dealt.mapInPandas(
        fill, "no_id boolean, doc_id long, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")
    return placed.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), *cols[1:],
                         "sequence_id", "offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str | None = None, end_id: int = 2, capacity: int = 1024,
                   items_per_packer: int = ITEMS_PER_PACKER) -> DataFrame:
    """Pieces of all documents with their places; the pieces' lengths are kept
    in the shared folder once, so that counting them doesn't tokenize twice."""
    pieces = cut_lineage(token_pieces(docs, id_col, text_col, vocabulary, end_id, capacity)
                         .drop("ids"))
    return pack(pieces, capacity, items_per_packer)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, from pieces
    made with ``keep_ids=True``; a group holds at most ``capacity`` tokens."""
    parts = placed.select("doc_id", "piece", "ids_crc32", "sequence_id", "offset", "length").join(
        pieces.select("doc_id", "piece", "ids_crc32", "ids").dropDuplicates(
            ["doc_id", "piece", "ids_crc32"]), ["doc_id", "piece", "ids_crc32"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return parts.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"))
