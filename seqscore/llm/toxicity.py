"""Toxicity scores by a factorization machine over hashed terms (op 2).

logit(x) = b + sum_i w_i + sum_{i<j} <v_i, v_j> over the distinct terms of a
text: w_i is a term's own weight, <v_i, v_j> what two terms mean together, so
that an insult beside a group mention can count for more than both alone.

Training reads a bounded sample of labelled documents (``max_rows``, those
with the smallest hash of their id) and runs in one task; scoring covers
every whole text and only ships the fitted model, whose size the number of
buckets bounds.

Terms that tell nothing of the label are left out before the fit, and the
fitted scores are calibrated by cross-fitting: each part of the sample is
scored by a machine that did not see it, and the line through those logits
that fits the labels best is put into the machine's weights.  A threshold then
means about the same in languages with many and with few labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, give_back

MAX_TRAINING_ROWS = 20_000
BUCKETS = 1 << 18
STEM = 4
_EDGE = ".,;:!?|\"'()[]{}<>*&%$#@-_/\\…«»„“”‘’¡¿"


def hashed_terms(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Sorted distinct buckets of the text's lower-cased words, edge
    punctuation left out, and of the first ``STEM`` letters of longer ones, so
    that inflected and compound forms share a term.  Null, empty and blank
    texts have none."""
    words = {w.strip(_EDGE) for w in set((text or "").lower().split())}
    words.discard("")
    words |= {w[:STEM] + "-" for w in words if len(w) > STEM}
    crc = zlib.crc32
    return np.unique(np.fromiter((crc(w.encode("utf-8", "surrogatepass")) for w in words),
                                 np.int64, len(words)) & (buckets - 1))


@dataclass
class FactorizationMachine:
    """Fitted weights of the buckets in ``terms`` (sorted); others count nothing."""
    terms: np.ndarray
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(rows), self.bias)
        if not len(self.terms) or not rows:
            return out
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at = np.minimum(np.searchsorted(self.terms, flat), len(self.terms) - 1)
        known = self.terms[at] == flat
        at, doc = at[known], doc[known]
        n = len(rows)
        out += np.bincount(doc, self.weight[at], n)
        for v in self.factors.T:
            x = v[at]
            out += 0.5 * (np.bincount(doc, x, n) ** 2 - np.bincount(doc, x * x, n))
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -35, 35)))

    def to_bytes(self) -> bytes:
        n, k = self.factors.shape
        return (np.array([n, k], "<i8").tobytes() + np.float64(self.bias).tobytes()
                + self.terms.astype("<i8").tobytes() + self.weight.astype("<f8").tobytes()
                + self.factors.astype("<f8").tobytes())

    @classmethod
    def from_bytes(cls, raw: bytes) -> FactorizationMachine:
        n, k = (int(x) for x in np.frombuffer(raw, "<i8", 2))
        at = 24
        return cls(np.frombuffer(raw, "<i8", n, at), float(np.frombuffer(raw, "<f8", 1, 16)[0]),
                   np.frombuffer(raw, "<f8", n, at + 8 * n),
                   np.frombuffer(raw, "<f8", n * k, at + 16 * n).reshape(n, k))


def informative(rows: list[np.ndarray], y: np.ndarray, least_documents: int, least_gain: float) -> np.ndarray:
    """Sorted terms of at least ``least_documents`` rows whose presence tells of
    the label: likelihood ratio statistic of the two by two table at least
    ``least_gain`` (6: one such term in 70 by chance)."""
    n, positives = len(y), float(y.sum())
    terms, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    seen = np.bincount(inverse, minlength=len(terms)).astype(float)
    toxic = np.bincount(inverse, np.repeat(y, [len(r) for r in rows]), len(terms))

    def part(count: np.ndarray, row: np.ndarray, column: float) -> np.ndarray:
        return count * np.log(np.maximum(count, 1e-300) * n / np.maximum(row * column, 1e-300))

    gain = 2 * (part(toxic, seen, positives) + part(seen - toxic, seen, n - positives)
                + part(positives - toxic, n - seen, positives)
                + part(n - positives - seen + toxic, n - seen, n - positives))
    return terms[(seen >= min(least_documents, max(1, n // 8))) & (gain >= least_gain)]


def fit(rows: list[np.ndarray], labels: np.ndarray, factors: int = 4, steps: int = 640,
        epochs: int = 8, batch: int = 256, rate: float = 0.3, l1: float = 1e-4, l2: float = 1e-4,
        pair_l2: float = 1e-2, least_documents: int = 4, least_gain: float = 6.0, power: float = 0.5,
        seed: int = 7) -> FactorizationMachine:
    """Minibatch AdaGrad on the logistic loss over the ``informative`` terms
    (``steps`` of them and ``epochs`` over the sample at least), the classes
    weighted towards balance by the root of their ratio; soft thresholding
    (``l1``) takes terms that add nothing to zero, so long texts gather no noise."""
    y = np.asarray(labels, np.float64)
    n, positives = len(y), float(np.sum(labels))
    prior = float(np.log((positives + 1) / (n - positives + 1)))
    none = FactorizationMachine(np.zeros(0, np.int64), prior, np.zeros(0), np.zeros((0, factors)))
    if not 0 < positives < n:
        return none
    terms = informative(rows, y, least_documents, least_gain)
    if not len(terms):
        return none
    rows = [np.searchsorted(terms, r[np.isin(r, terms, assume_unique=True)]) for r in rows]
    rng = np.random.default_rng(seed)
    size = len(terms)
    b, w, v = prior, np.zeros(size), rng.normal(0, 0.01, (size, factors))
    gb, gw, gv = 1e-6, np.full(size, 1e-6), np.full((size, factors), 1e-6)
    lift = ((n - positives) / positives) ** power
    batch = min(batch, max(32, n // 16))
    for _ in range(max(epochs, -(-steps * batch // n))):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            part = order[lo:lo + batch]
            lengths = np.array([len(rows[i]) for i in part])
            idx = np.concatenate([rows[i] for i in part]) if lengths.sum() else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(part)), lengths)
            m = len(part)
            x = v[idx]
            sums = np.stack([np.bincount(doc, x[:, f], m) for f in range(factors)], 1)
            squares = np.stack([np.bincount(doc, x[:, f] ** 2, m) for f in range(factors)], 1)
            z = b + np.bincount(doc, w[idx], m) + 0.5 * (sums ** 2 - squares).sum(1)
            g = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[part]
            g = g * np.where(y[part] > 0, lift, 1) / m
            grad = float(g.sum())
            gb += grad ** 2
            b -= rate * grad / np.sqrt(gb)
            used, local = np.unique(idx, return_inverse=True)
            if not len(used):
                continue
            each = g[doc]
            grad_w = np.bincount(local, each, len(used)) + l2 * w[used]
            gw[used] += grad_w ** 2
            step = rate / np.sqrt(gw[used])
            new = w[used] - step * grad_w
            w[used] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
            grad_v = np.stack([np.bincount(local, each * (sums[doc, f] - x[:, f]), len(used))
                               for f in range(factors)], 1) + pair_l2 * v[used]
            gv[used] += grad_v ** 2
            step = rate * 0.5 / np.sqrt(gv[used])
            new = v[used] - step * grad_v
            v[used] = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
    live = (w != 0) | (v != 0).any(axis=1)
    return FactorizationMachine(terms[live], float(b), w[live], v[live])


def _line(z: np.ndarray, y: np.ndarray, prior: float = 1.0) -> tuple[float, float]:
    """Slope (above zero) and shift of logits ``z`` that fit the labels best, by
    Newton steps on the logistic loss; ``prior`` holds them to 1 and 0 where
    there is little to learn from, as where the labels are told apart wholly."""
    x = np.stack([z, np.ones(len(z))], 1)
    at, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])

    def loss(b: np.ndarray) -> float:
        f = x @ b
        return float((np.logaddexp(0, f) - y * f).sum() + prior / 2 * ((b - start) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -35, 35)))
        gradient = x.T @ (p - y) + prior * (at - start)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + prior * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return max(float(at[0]), 1e-3), float(at[1])


def fit_calibrated(rows: list[np.ndarray], labels: np.ndarray, parts: int = 4, **options) -> FactorizationMachine:
    """``fit`` on all rows, its logits put on the line that fits the labels of
    rows held out in turn.  Rows with the same terms are in the same part, so
    that copies don't vouch for each other.  A scaled machine is a machine: the
    slope goes into bias and weights, its root into the factors."""
    whole = fit(rows, labels, **options)
    y = np.asarray(labels, np.float64)
    part = np.array([zlib.crc32(r.tobytes()) % parts for r in rows], np.int64)
    if not len(whole.terms) or any(not 0 < y[part != k].sum() < (part != k).sum() for k in range(parts)):
        return whole
    z = np.zeros(len(rows))
    for k in range(parts):
        out, rest = np.flatnonzero(part == k), np.flatnonzero(part != k)
        z[out] = fit([rows[i] for i in rest], y[rest], **options).logits([rows[i] for i in out])
    slope, shift = _line(z, y)
    return FactorizationMachine(whole.terms, slope * whole.bias + shift, slope * whole.weight,
                                slope ** 0.5 * whole.factors)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS,
          buckets: int = BUCKETS) -> FactorizationMachine:
    """Fit, with calibration, on documents with a 0/1 label: at most ``max_rows`` labelled ids, by
    the smallest hash, and of their rows as many, by the smallest hash of id and
    text (an id may have any number of rows).  Labels that are null or other values are left out; an
    id with both labels counts as 1.  Without both classes the model is the
    prior alone."""
    sample = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
              .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the sample has max_rows rows of two numbers at most
    chosen = texts.join(F.broadcast(sample), "id")

    @F.pandas_udf(T.BinaryType())
    def terms(s: pd.Series) -> pd.Series:
        return s.map(lambda t: hashed_terms(t, buckets).astype("<i4").tobytes(), na_action=None)

    def learn(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["id", "terms"])
        rows = [np.frombuffer(t, "<i4").astype(np.int64) for t in f["terms"]]
        return pd.DataFrame({"model": [fit_calibrated(rows, f["y"].to_numpy()).to_bytes()]})

    bounded = (chosen.select("id", "y", F.xxhash64("id", "text").alias("draw"), terms("text").alias("terms"))
               .orderBy("draw", "id").limit(max_rows))
    found = (bounded.select("id", "y", "terms").groupBy(F.lit(0).alias("all")).applyInPandas(learn, "model binary").collect())
    if not found:
        return FactorizationMachine(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, 1)))
    return FactorizationMachine.from_bytes(bytes(found[0]["model"]))


def score(spark: SparkSession, model: FactorizationMachine, text: Column,
          buckets: int = BUCKETS) -> Column:
    """Probability-like score in 0..1 of whole texts; a text without known
    terms gets the model's bias."""
    shared = spark.sparkContext.broadcast(model.to_bytes())

    @F.pandas_udf(T.DoubleType())
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = FactorizationMachine.from_bytes(shared.value)
        for s in texts:
            out = []
            for at in range(0, len(s), 512):
                out.append(fitted.scores([hashed_terms(t, buckets) for t in s.iloc[at:at + 512]]))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
        give_back()

    return apply(text)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = 0.7, folds: int = 3,
             held_out_fold: int = 1, **training) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; labels of
    ids whose crc32 modulo ``folds`` is ``held_out_fold`` are never learned.
    Null and empty texts get the score of a text without known terms, equal
    texts equal scores; a null id counts as empty text in the folds, and its
    labels are not learned.  Repeated rows all come back; no rows give none."""
    known = labels.filter(fold(F.col(id_col), folds) != held_out_fold)
    model = train(docs, known, id_col, text_col, label_col, **training)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (fold(F.col(id_col), folds) == held_out_fold).alias("held_out"),
        score(docs.sparkSession, model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
