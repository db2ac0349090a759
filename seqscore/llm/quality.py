"""Quality by the perplexity of a modified Kneser-Ney model (op 10).

The model is an interpolated 5-gram model over the UTF-8 bytes of texts, with
three discounts an order, trained on all trusted text.  Its counts live in
tables sharded by n-gram: contexts, discounts and lower orders meet by joins,
and nothing of them passes through the driver but the counts of counts.  Five
bytes fit one long, so n-grams are exact, not hashed.

For scoring, the probabilities are written sorted into the shared folder in
files of bounded size.  A task gathers the distinct n-grams of a block of
texts, streams the files past them (a merge join, one row group in memory at
a time) and sums the documents' log-probabilities; texts are not shuffled.

A word equal to the one before it is read as one sign of its own.  Within a
run, such signs foretell each other, so that a text of repeated words would
pass for fluent; documents are therefore judged with each such sign at its
frequency in trusted text, whatever comes before it: as unlikely as it is rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RangeReader, cut_lineage, fold, free_name, free_prefix, give_back, scratch_path

ORDER = 5
REPEAT = "\x01"
REPEAT_STEP = 2 * ORDER
"""The model's last step: one row with the log-frequency of the repeat sign."""
BLOCK_BYTES = 1 << 20
"""Bytes of text whose n-grams a task holds at a time."""
SHORT = 2.0
"""Standard deviation, in nats, allowed to the log-probability of one byte."""


def symbols(text: str | None) -> bytes:
    """The bytes the model reads for a text: words joined by single blanks (line
    breaks count as blanks), a repeated word and its blank as one sign."""
    words = (text or "").split()
    if not words:
        return b""
    if any(a == b for a, b in zip(words, words[1:], strict=False)):
        words = [words[0], *(REPEAT if a == b else b for a, b in zip(words, words[1:], strict=False))]
    return " ".join(words).replace(" " + REPEAT, REPEAT).encode("utf-8", "surrogatepass")


def ngrams(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, lengths): the n-gram that ends in each byte, first byte highest,
    every text preceded by ORDER - 1 and followed by one zero byte (which ends
    it); lengths counts the n-grams of each text."""
    pad = b"\0" * (ORDER - 1)
    raw = np.frombuffer(b"".join(pad + p + b"\0" for p in parts), np.uint8)
    lengths = np.array([len(p) + 1 for p in parts], np.int64)
    if not len(raw):
        return np.zeros(0, np.int64), lengths
    codes = np.zeros(len(raw) - ORDER + 1, np.int64)
    for i in range(ORDER):
        codes = (codes << 8) | raw[i:len(codes) + i]
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER - 1)[:-1]])
    keep = np.ones(len(codes) + ORDER - 1, bool)
    ends = starts + lengths
    for i in range(ORDER - 1):  # n-grams that reach over the border of two texts
        keep[ends[:-1] + i] = False
    return codes[keep[:len(codes)]], lengths


def _blocks(texts: list) -> Iterator[list[bytes]]:
    block, held = [], 0
    for t in texts:
        s = symbols(t)
        if block and held + len(s) > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append(s)
        held += len(s)
    if block:
        yield block


def ngram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(code, c): how often each n-gram of the highest order occurs."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for f in frames:
            for block in _blocks(f["text"].tolist()):
                block = [b for b in block if b]
                if not block:
                    continue
                c, k = np.unique(ngrams(block)[0], return_counts=True)
                codes, at = np.unique(np.concatenate([codes, c]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, k]), len(codes)).astype(np.int64)
                if len(codes) > 1 << 20:
                    yield pd.DataFrame({"code": codes, "c": n})
                    codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(codes):
            yield pd.DataFrame({"code": codes, "c": n})

    return (docs.select(F.col(text_col).alias("text")).mapInPandas(count, "code long, c long")
            .groupBy("code").agg(F.sum("c").alias("c")))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the counts of counts (four numbers)."""
    n = {r["c"]: r["n"] for r in counts.filter("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    # kept below each count, so that no probability is negative or lost
    held = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(held, 1))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(step, code, value) of the model: steps 0, 2, 4, ... hold the
    log-probabilities of the seen n-grams of order 5, 4, ..., steps 1, 3, ...
    the log back-off weights of the contexts of those orders, and REPEAT_STEP
    the log of the repeat sign's share of all bytes (one added to each byte's
    count, as the sign may not occur)."""
    tables = {ORDER: cut_lineage(counts)}
    for k in range(ORDER - 1, 0, -1):  # in how many contexts a lower-order n-gram occurs
        tables[k] = cut_lineage(
            tables[k + 1].select((F.col("code").bitwiseAND((1 << 8 * k) - 1)).alias("code"))
            .groupBy("code").agg(F.count("*").alias("c")))
    lower, out = None, None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(tables[k])
        c = F.col("c")
        taken = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        t = tables[k].withColumn("ctx", F.call_function("shiftright", "code", F.lit(8)))
        contexts = t.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum(taken).alias("mass")).select(
            "ctx", "total", (F.col("mass") / F.col("total")).alias("backoff"))
        p = t.join(contexts, "ctx").withColumn("own", (c - taken) / F.col("total"))
        if lower is None:
            p = p.withColumn("below", F.lit(1 / 256))
        else:
            p = p.withColumn("suffix", F.col("code").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(
                lower.select(F.col("code").alias("suffix"), F.col("p").alias("below")), "suffix")
        lower = cut_lineage(p.select("code", (F.col("own") + F.col("backoff") * F.col("below")).alias("p")))
        step = 2 * (ORDER - k)
        rows = lower.select(F.lit(step).alias("step"), "code", F.log("p").cast("float").alias("value")).union(
            contexts.select(F.lit(step + 1), "ctx", F.log("backoff").cast("float")))
        out = rows if out is None else out.union(rows)
    sign = ord(REPEAT)
    repeats = F.sum(F.when(F.col("code").bitwiseAND(255) == sign, F.col("c")).otherwise(0))
    share = (F.coalesce(repeats, F.lit(0)) + 1) / (F.coalesce(F.sum("c"), F.lit(0)) + 256)
    return out.union(tables[ORDER].agg(F.log(share).cast("float").alias("value")).select(
        F.lit(REPEAT_STEP), F.lit(sign).cast("long"), "value"))


def write_model(model: DataFrame, path: str) -> list[str]:
    """The model in files sorted by (step, code); their names in that order."""
    spark = model.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (model.repartitionByRange(n, "step", "code").sortWithinPartitions("step", "code")
     .write.option("parquet.block.size", str(16 << 20)).mode("error").parquet(path))
    files = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
             .agg(F.min(F.struct("step", "code")).alias("first")).orderBy("first").collect())
    return [r["f"] for r in files]


class ModelFiles:
    """Streams the model past sets of n-grams."""

    def __init__(self, files: list[str], kept_rows: int = 1 << 20):
        self._files, self._kept, self._room = files, {}, kept_rows

    def _groups(self) -> Iterator[tuple[np.ndarray, ...]]:
        import pyarrow.parquet as pq
        for name in self._files:
            if name in self._kept:
                yield from self._kept[name]
                continue
            with RangeReader(name) as r:
                f = pq.ParquetFile(r.file)
                keep = f.metadata.num_rows <= self._room  # what fits; the rest is read anew
                held = []
                for g in range(f.num_row_groups):
                    t = f.read_row_group(g, columns=["step", "code", "value"])
                    group = tuple(t.column(c).to_numpy() for c in ("step", "code", "value"))
                    if keep:
                        held.append(group)
                    yield group
                if keep:
                    self._kept[name] = held
                    self._room -= f.metadata.num_rows

    def log_probabilities(self, codes: np.ndarray, lone_repeats: bool = False) -> np.ndarray:
        """log p of each n-gram's last byte after the bytes before it; with
        ``lone_repeats``, of a repeat sign regardless of them."""
        acc = np.zeros(len(codes))
        alone = np.log(1 / 256)
        open_ = np.ones(len(codes), bool)
        now, keys, order = -1, None, None
        for step, code, value in self._groups():
            if step[-1] == REPEAT_STEP:
                alone = value[-1]
            for s in range(int(step[0]), min(int(step[-1]) + 1, REPEAT_STEP)):
                a, b = np.searchsorted(step, s), np.searchsorted(step, s, "right")
                if a == b:
                    continue
                if s != now:
                    at = np.flatnonzero(open_)
                    k = codes[at] & ((1 << 8 * (ORDER - s // 2)) - 1)
                    k = k >> 8 if s % 2 else k
                    order = np.argsort(k, kind="stable")
                    keys, order, now = k[order], at[order], s
                lo, hi = np.searchsorted(keys, code[a]), np.searchsorted(keys, code[b - 1], "right")
                if lo == hi:
                    continue
                want = keys[lo:hi]
                pos = np.searchsorted(code[a:b], want)
                hit = code[a:b][np.minimum(pos, b - a - 1)] == want
                rows = order[lo:hi][hit]
                acc[rows] += value[a:b][pos[hit]]
                if s % 2 == 0:
                    open_[rows] = False
        acc[open_] += np.log(1 / 256)  # a byte never seen: uniform below order 1
        if lone_repeats:
            acc[(codes & 255) == ord(REPEAT)] = alone
        return acc


def perplexities(docs: DataFrame, files: list[str], text_col: str = "text", out: str = "ppl",
                 lone_repeats: bool = False) -> DataFrame:
    """``docs`` with a column ``out`` of (perplexity, lower): the perplexity per
    byte and its lower bound by the text's length, as a short text's perplexity
    says less; null for texts without a word.  With ``lone_repeats``, a repeat
    sign counts by its frequency in the training text, not by its context."""
    shared = docs.sparkSession.sparkContext.broadcast(files)

    @F.pandas_udf("perplexity double, lower double")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = ModelFiles(shared.value)
        for s in texts:
            found = []
            for block in _blocks(s.tolist()):
                codes, lengths = ngrams(block)
                distinct = np.unique(codes)
                logp = model.log_probabilities(distinct, lone_repeats)
                each = logp[np.searchsorted(distinct, codes)]
                sums = np.add.reduceat(each, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
                nats = -sums / lengths
                found += [(None, None) if not b else (float(np.exp(x)), float(np.exp(x - SHORT / n ** 0.5)))
                          for b, x, n in zip(block, nats, lengths, strict=True)]
            yield pd.DataFrame(found, columns=["perplexity", "lower"], dtype="float64")
        del model
        give_back()

    return docs.withColumn(out, apply(F.col(text_col)))


def train(spark: SparkSession, trusted: DataFrame, text_col: str = "text") -> list[str]:
    """Fit the model on all of ``trusted``; the names of its files."""
    return write_model(kneser_ney(ngram_counts(trusted, text_col)), scratch_path(spark, "language-model"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", label_col: str = "quality", quantile: float = 0.998,
           margin: float = 1.2, folds: int = 5, prefix: str = "") -> DataFrame:
    """``docs``, all rows and columns, with the columns ``prefix`` + perplexity,
    lower, threshold and keep.

    Trusted are documents whose label is 1.  All but one fold of them train the
    model; ``margin`` times the ``quantile`` of the lower bounds of the fold
    left out, language by language, is the threshold (of all languages together
    where a language has none; a null language is one of its own).  The margin
    covers the error of a quantile of few documents.  Both sides take repeat
    signs by their frequency (``lone_repeats``).  keep is 1 for lower
    bounds up to the threshold, 0 above it, and 0 for texts without a word;
    without any trusted text left out, every text with a word is kept."""
    spark = docs.sparkSession
    good = (labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("id"))
            .filter("id is not null").distinct().hint("merge"))  # labels grow with the documents: never broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).alias("text"))
    out = fold(F.col("id"), folds) == 0
    files = train(spark, rows.filter(~out).join(good.filter(~out), "id", "left_semi"), "text")
    measured = cut_lineage(
        perplexities(rows.filter(out).join(good.filter(out), "id", "left_semi"), files, lone_repeats=True)
        .select("lang", "ppl.lower").filter("lower is not null"))
    cut = F.percentile_approx("lower", quantile, 10_000) * margin
    overall = measured.agg(cut).first()[0]
    # one row for each language
    lang, most, found = (free_name(docs.columns, x) for x in ("__lang", "__t", "__ppl"))
    per_language = measured.groupBy(F.col("lang").alias(lang)).agg(cut.alias(most))
    ppl, low, top = (f"{prefix}{x}" for x in ("perplexity", "lower", "threshold"))
    scored = perplexities(docs, files, text_col, found, lone_repeats=True).join(
        F.broadcast(per_language), F.col(lang_col).cast("string").eqNullSafe(F.col(lang)), "left")
    keep = F.col(low).isNotNull() & (F.col(top).isNull() | (F.col(low) <= F.col(top)))
    return (scored.withColumns({ppl: F.col(f"{found}.perplexity"), low: F.col(f"{found}.lower"),
                                top: F.coalesce(most, F.lit(overall).cast("double"))})
            .withColumn(f"{prefix}keep", keep.cast("int")).drop(lang, most, found))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", label_col: str = "quality", **options) -> DataFrame:
    """doc_id, lang, perplexity, lower, threshold, keep for every row of ``docs``, see
    ``judged``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("quality"))
    return judged(rows, known, **options).drop("text")


def keep_within(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with their own columns."""
    p = free_prefix(docs.columns, "__quality_")
    return judged(docs, labels, prefix=p, **options).filter(f"{p}keep = 1").select(*docs.columns)
