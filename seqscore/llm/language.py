"""Language identification by multilingual mixture inference (op 7).

Each language has a distribution over hashed letter trigrams, learned from
the documents that state it.  A text is a mixture: every word comes from one
language, chosen with the text's unknown proportions.  Expectation
maximisation finds the proportions from the words' n-gram likelihoods, and
languages are taken out of the set as long as the penalised likelihood
(log-likelihood less ``penalty`` * ln(words) for each language beyond the
first) grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold

BUCKET_BITS = 16
CHARS_AT_ONCE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_trigrams(texts: list[str | None], bits: int = BUCKET_BITS) -> tuple[np.ndarray, ...]:
    """(bucket, word, text) of all letters: the trigram around each letter,
    words being runs of letters with a blank at either end; word and text
    number the words, and the texts they stand in, from 0."""
    joined = "\x00 ".join((t or "").lower() for t in texts) + "\x00 "
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    # only the separator of texts is a NUL that a blank follows
    letter = _letters()[cp]
    sep = (cp[:-1] == 0) & (cp[1:] == 32)
    text = np.concatenate([[0], np.cumsum(sep)])
    if sep.sum() != len(texts):  # a text holds a NUL itself
        clean = [(t or "").replace("\x00", " ") for t in texts]
        return letter_trigrams(clean, bits)
    c = np.where(letter, cp, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.where(at > 0, c[at - 1], 0)
    h = (before * np.uint32(0x9E3779B1)) ^ (c[at] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35) + c[at + 1] * np.uint32(0x165667B1)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0x2C1B3C6D)
    word = np.cumsum(before == 0) - 1
    return (h >> np.uint32(32 - bits)).astype(np.int64), word, text[at]


@dataclass
class TrigramModel:
    languages: list[str]
    logp: np.ndarray  # buckets x languages


def _blocks(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about CHARS_AT_ONCE characters."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and held + n > CHARS_AT_ONCE:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          bits: int = BUCKET_BITS, smoothing: float = 0.5) -> TrigramModel:
    """Trigram distributions of every non-null language, counted over all given
    documents; tasks send at most one count for each bucket and language."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for f in frames:
            for lang, part in f.groupby("lang"):
                have = totals.setdefault(lang, np.zeros(1 << bits, np.int64))
                texts = part["text"].tolist()
                for a, b in _blocks(texts):
                    bucket, _, _ = letter_trigrams(texts[a:b], bits)
                    have += np.bincount(bucket, minlength=1 << bits)
        for lang, have in totals.items():
            at = np.flatnonzero(have)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": have[at]})
            if not len(at):
                yield pd.DataFrame({"lang": [lang], "bucket": np.int32([0]), "n": [0]})

    counts = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
              .filter("lang is not null and text is not null")
              .mapInPandas(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # at most 2^bits counts for each language
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((1 << bits, len(languages)))
    for i, lang in enumerate(languages):
        part = found[found["lang"] == lang]
        table[part["bucket"].to_numpy(), i] = part["n"].to_numpy()
    logp = np.log(table + smoothing) - np.log(table.sum(0) + smoothing * (1 << bits))
    return TrigramModel(languages, logp.astype(np.float32))


def _proportions(like: np.ndarray, weight: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """EM for one text: proportions and log-likelihood given the words' scaled
    likelihoods (words x languages) and weights."""
    p = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(rounds):
        joint = like * p
        total = joint.sum(1, keepdims=True)
        new = (weight[:, None] * joint / total).sum(0) / weight.sum()
        if np.abs(new - p).max() < 1e-5:
            p = new
            break
        p = new
    return p, float((weight * np.log((like * p).sum(1))).sum())


def _mixture_gain(gap: np.ndarray, first: np.ndarray, sizes: np.ndarray, main: np.ndarray,
                  rounds: int = 10) -> np.ndarray:
    """EM for all texts of a block at once, over all languages: the reached
    log-likelihood relative to every word's own best language."""
    like = np.exp(gap).astype(np.float32) + np.float32(1e-30)
    doc = np.repeat(np.arange(len(first)), sizes)
    p = np.full((len(first), like.shape[1]), 0.1 / like.shape[1], np.float32)
    p[np.arange(len(first)), main] += 0.9
    for _ in range(rounds):
        joint = like * p[doc]
        joint /= joint.sum(1, keepdims=True)
        new = np.add.reduceat(joint, first, axis=0) / sizes[:, None].astype(np.float32)
        done = np.abs(new - p).max() < 1e-3
        p = new
        if done:
            break
    return np.add.reduceat(np.log((like * p[doc]).sum(1, dtype=np.float64)), first)


def select_languages(loglik: np.ndarray, penalty: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
    """(languages, proportions) of one text by backward elimination, from its
    words' log-likelihoods (words x languages)."""
    like = np.exp(loglik - loglik.max(1, keepdims=True)) + 1e-30
    weight = np.ones(len(like))
    cost = penalty * np.log(len(like) + 1)
    chosen = np.arange(like.shape[1])
    p, ll = _proportions(like, weight)
    # languages that no word leans to can't pay for themselves
    live = p > 1e-3 / len(like)
    chosen, p = chosen[live], p[live]
    while len(chosen) > 1:
        tries = []
        for i in range(len(chosen)):
            rest = np.delete(chosen, i)
            q, l2 = _proportions(like[:, rest], weight)
            tries.append((l2, -i, rest, q))
        l2, _, rest, q = max(tries, key=lambda t: (t[0], t[1]))
        if l2 + cost < ll:
            break
        chosen, p, ll = rest, q, l2
    return chosen, p


def infer(texts: list[str | None], model: TrigramModel, penalty: float = 2.0
          ) -> list[tuple[str, float, list[str], list[float]]]:
    """(language, score, languages, proportions) of each text; the score is the
    proportion of its main language.  Texts without a letter are ``und``."""
    out: list = [("und", 0.0, [], [])] * len(texts)
    n_lang = len(model.languages)
    if not n_lang:
        return out
    bits = int(len(model.logp)).bit_length() - 1
    for lo, hi in _blocks(texts):
        bucket, word, text = letter_trigrams(texts[lo:hi], bits)
        if not len(bucket):
            continue
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        loglik = np.add.reduceat(model.logp[bucket], starts, axis=0).astype(np.float64)
        owner = text[starts]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        top = loglik.max(1, keepdims=True)
        best = np.add.reduceat(loglik, first, axis=0)
        sizes = np.diff([*first, len(owner)])
        gain = _mixture_gain(loglik - top, first, sizes, best.argmax(1)) - (
            best.max(1) - np.add.reduceat(top[:, 0], first))
        for k, (s, n) in enumerate(zip(first.tolist(), sizes.tolist(), strict=True)):
            main = int(best[k].argmax())
            if gain[k] <= penalty * np.log(n + 1):  # all languages together don't pay for a second
                chosen, p = np.array([main]), np.ones(1)
            else:
                chosen, p = select_languages(loglik[s:s + n], penalty)
            order = np.argsort(-p, kind="stable")
            names = [model.languages[chosen[i]] for i in order]
            share = [min(1.0, float(p[i])) for i in order]
            if len(names) == 1:
                # how sure a set of one is: its posterior against the runner-up, a word's worth
                gap = (best[k, main] - np.partition(best[k], -2)[-2]) / n if n_lang > 1 else 35.0
                share_score = float(1 / (1 + np.exp(-min(35.0, max(-35.0, gap)))))
            else:
                share_score = share[0]
            out[lo + int(owner[s])] = (names[0], share_score, names, share)
    return out


RESULT = "lang string, score double, languages array<string>, proportions array<double>"


def identify(docs: DataFrame, model: TrigramModel, id_col: str = "doc_id", text_col: str = "text",
             penalty: float = 2.0) -> DataFrame:
    """doc_id, lang_pred, score, languages, proportions for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame(infer(s.tolist(), shared.value, penalty),
                               columns=["lang", "score", "languages", "proportions"])

    r = F.col("r")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), apply(F.col(text_col)).alias("r"))
            .select("doc_id", r["lang"].alias("lang_pred"), r["score"].alias("score"),
                    r["languages"].alias("languages"), r["proportions"].alias("proportions")))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", folds: int = 5, held_out_fold: int = 0,
                penalty: float = 2.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, proportions for every row;
    learned from the documents outside the held-out fold that state a language."""
    model = train(docs.filter(fold(F.col(id_col), folds) != held_out_fold), text_col, lang_col)
    found = identify(docs, model, id_col, text_col, penalty)
    return found.select("doc_id", (fold(F.col("doc_id"), folds) == held_out_fold).alias("held_out"),
                        "lang_pred", "score", "languages", "proportions")
