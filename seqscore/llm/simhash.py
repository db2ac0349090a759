"""SimHash near-duplicates by meet-in-the-middle ball hashing (op 1).

Two fingerprints at most d bits apart share a variant that lies within half
the distance of each.  Every distinct fingerprint emits all its variants
within ceil(d / 2) bits, the variants are shuffled, and the fingerprints that
meet on a variant are linked, deduplicated and verified by their distance.

A variant gathers at most the fingerprints of its own ball (65 for d = 2), as
equal fingerprints are one before variants are made: however many copies a
text has, no group grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut_lineage, free_name, give_back
from .components import connected_components

MAX_DISTANCE = 4
_HASHES_AT_ONCE = 1 << 16


def _fingerprint(text: str | None, words_per_shingle: int, seed: int) -> int:
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    n = len(words) - k + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed),
                             map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))),
                         ">u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _HASHES_AT_ONCE):
        part = hashes[at:at + _HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def simhash(text: Column, words_per_shingle: int = 3, seed: int = 42) -> Column:
    """64-bit fingerprint (as a signed long) of whole texts.

    A-Z are lower-cased, words are runs of bytes other than ASCII white space,
    shingles are runs of ``words_per_shingle`` words (all of them when there
    are fewer), repeats included.  A bit is set if more than half of the
    shingles' XXH64 values have it.  Null, empty and blank texts give zero."""
    @F.pandas_udf(T.LongType())
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([_fingerprint(t, words_per_shingle, seed) for t in s], dtype="int64")
        give_back()

    return fingerprint(text)


def _masks(lowest: int, highest: int) -> Column:
    """All 64-bit masks of ``lowest`` to ``highest`` set bits (at most two)."""
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    parts = []
    if lowest <= 0 <= highest:
        parts.append(F.array(F.lit(0).cast("long")))
    if lowest <= 1 <= highest:
        parts.append(F.transform(F.sequence(F.lit(0), F.lit(63)), one))
    if lowest <= 2 <= highest:
        parts.append(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(62)), lambda i: F.transform(
            F.sequence(i + 1, F.lit(63)), lambda j: one(i).bitwiseOR(one(j))))))
    return F.concat(*parts) if parts else F.array().cast("array<long>")


def fingerprint_links(fingerprints: DataFrame, col: str, max_distance: int) -> DataFrame:
    """(a, b) links between different fingerprints at most ``max_distance``
    bits apart, enough to connect every such pair.

    On a variant, a fingerprint within floor(d / 2) of it is linked with all
    others there, which lie within ceil(d / 2); the smallest such stands for
    them, so that a variant gives a star and not all pairs."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"max_distance {max_distance} is outside 0..{MAX_DISTANCE}")
    near, far = max_distance // 2, -(-max_distance // 2)
    variants = None
    for outer, (low, high) in enumerate([(0, near), (near + 1, far)]):
        if low <= high:
            v = fingerprints.select(F.col(col).alias("f"), F.lit(outer).alias("outer"),
                                    F.explode(_masks(low, high)).alias("m"))
            v = v.select("f", "outer", F.col("f").bitwiseXOR(F.col("m")).alias("variant"))
            variants = v if variants is None else variants.union(v)
    if near == far:
        meet = Window.partitionBy("variant").orderBy("f")
        met = variants.select("f", F.first("f").over(meet).alias("anchor"))
    else:
        meet = Window.partitionBy("variant").orderBy("outer", "f")
        met = (variants.select("f", F.first(F.struct("outer", "f")).over(meet).alias("x"))
               .filter("x.outer = 0").select("f", F.col("x.f").alias("anchor")))
    return (met.filter("f != anchor").select(F.least("f", "anchor").alias("a"),
                                             F.greatest("f", "anchor").alias("b")).distinct()
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))


def _smallest_by_print(prints: DataFrame, what: Column, max_distance: int) -> DataFrame:
    """(f, best): for every fingerprint, the smallest ``what`` of all rows of its
    component; minima by partial aggregation, first by fingerprint."""
    classes = cut_lineage(prints.groupBy("f").agg(F.min(what).alias("first")))
    roots = connected_components(fingerprint_links(classes, "f", max_distance))
    grouped = (classes.join(roots.withColumnRenamed("node", "f"), "f", "left")
               .select("f", "first", F.coalesce("component", "f").alias("root")))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("best"))
    return grouped.join(smallest, "root").select("f", "best")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    ``component_id`` is the smallest id of the documents reachable over
    fingerprints at most ``max_distance`` bits apart, the document's own
    included; null only where no document of the component has an id."""
    prints = cut_lineage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        simhash(F.col(text_col), words_per_shingle).alias("f")))
    by_print = _smallest_by_print(prints, F.col("doc_id"), max_distance)
    return prints.join(by_print, "f").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.col("best").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               words_per_shingle: int = 3, max_distance: int = 2, repeats: bool = True) -> DataFrame:
    """The first row of each component, all columns: the one with the smallest
    id (a row without an id comes last), among equal ids the one whose text
    hashes lowest.  Rows of that component that repeat the id stay too, unless
    ``repeats`` is false: then exactly one row of each component stays.

    Rows are told apart by a number of their own, pinned by a checkpoint, and
    not by ids: these may be missing or given to different texts."""
    row = free_name(docs.columns, "__row")
    rows = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    prints = cut_lineage(rows.select(
        F.col(row).alias("__row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("hash"),
        simhash(F.col(text_col), words_per_shingle).alias("f")))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash", "__row")
    first = F.col("__row") == F.col("best.__row")
    if repeats:
        first = first | F.coalesce(F.col("doc_id") == F.col("best.doc_id"), F.lit(False))
    dropped = prints.join(_smallest_by_print(prints, rank, max_distance), "f").filter(~first).select(
        F.col("__row").alias(row))
    return rows.join(dropped, row, "left_anti").select(*docs.columns)
