from collections import Counter, defaultdict

import numpy as np
import pytest

from seqscore.llm import quality as Q


def plain_kneser_ney(texts):
    """The model by its definition, in dictionaries; p(byte | up to 4 bytes)."""
    top = Counter()
    for t in texts:
        s = Q.symbols(t)
        if s:
            raw = b"\0" * 4 + s + b"\0"
            top.update(raw[i:i + 5] for i in range(len(raw) - 4))
    tables = {5: top}
    for k in (4, 3, 2, 1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    held, contexts = {}, {}
    for k, t in tables.items():
        n = Counter(t.values())
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
            held[k] = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
        else:
            held[k] = [0.5, 0.75, 0.9]
        ctx = defaultdict(list)
        for g, c in t.items():
            ctx[g[:-1]].append(c)
        contexts[k] = ctx

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / 256
        seen = contexts[k].get(gram[:-1])
        if not seen:
            return p(gram[1:])
        d = lambda c: held[k][min(c, 3) - 1]
        c = tables[k].get(gram, 0)
        return ((c - d(c)) if c else 0) / sum(seen) + sum(map(d, seen)) / sum(seen) * p(gram[1:])
    return p


def plain_perplexity(p, text):
    s = Q.symbols(text)
    if not s:
        return None
    raw = b"\0" * 4 + s + b"\0"
    return float(np.exp(-np.mean([np.log(p(raw[i:i + 5])) for i in range(len(raw) - 4)])))


TRUSTED = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "été à la plage", "", None, "mat mat mat"]


def test_perplexities_equal_the_definition(spark):
    files = Q.train(spark, spark.createDataFrame([(t,) for t in TRUSTED], "text string"))
    p = plain_kneser_ney(TRUSTED)
    texts = [*TRUSTED, "the cat", "zzz qqq", "the the the the", "x", " ", "日本", "the cat sat on the dog " * 50]
    rows = Q.perplexities(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, i int"),
                          files).orderBy("i").collect()
    for r, t in zip(rows, texts, strict=True):
        want = plain_perplexity(p, t)
        assert (r.ppl.perplexity is None) if want is None else r.ppl.perplexity == pytest.approx(want, rel=1e-4)


def test_probabilities_add_up_to_one():
    p = plain_kneser_ney(TRUSTED)
    for ctx in (b"the ", b"\0\0\0\0", b"zzzz", b"at o"):
        assert sum(p(ctx + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_symbols():
    assert Q.symbols("a  b\n c ") == b"a b c"
    assert Q.symbols("no no no yes") == b"no\x01\x01 yes"
    assert Q.symbols(None) == Q.symbols(" \n") == b""


def corpus(n=300):
    rng = np.random.default_rng(0)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna", "aliqua"]
    docs, labels = [], []
    for i in range(n):
        good = i % 6 != 0
        t = " ".join(rng.choice(words, 25)) if good else " ".join("".join(rng.choice(list("#%&xqz"), 5)) for _ in range(20))
        docs.append((i, t, ["en", "fr", None][i % 3 if i % 3 < 2 or i % 9 else 2], "s", 1.5))
        labels.append((i, int(good)))
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, source string, perplexity double"


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = corpus()
    docs += [(900, None, "en", "s", 0.0), (901, " ", "xx", "s", 0.0), (902, "lorem ipsum", "xx", "s", 0.0),
             (None, "dolor sit amet", "en", "s", 0.0), (4, docs[4][1], "en", "s", 0.0)]
    labels += [(None, 1), (902, None), (777, 1)]
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    got = Q.quality(d, lab).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is not None and r.doc_id < 300:
            assert r.keep == int(r.doc_id % 6 != 0)
    by = {r.doc_id: r.keep for r in got}
    assert (by[900], by[901], by[902], by[None]) == (0, 0, 1, 1)
    kept = Q.keep_within(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(r.keep for r in got)


def test_repeat_signs_count_by_their_frequency(spark):
    files = Q.train(spark, spark.createDataFrame([(t,) for t in TRUSTED], "text string"))
    p, read = plain_kneser_ney(TRUSTED), b"".join(Q.symbols(t) + b"\0" for t in TRUSTED if Q.symbols(t))
    share = (read.count(b"\x01") + 1) / (len(read) + 256)
    texts = ["mat mat mat", "the the the the cat", "a cat", "zzz zzz"]
    rows = Q.perplexities(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, i int"),
                          files, lone_repeats=True).orderBy("i").collect()
    for r, t in zip(rows, texts, strict=True):
        raw = b"\0" * 4 + Q.symbols(t) + b"\0"
        want = [share if raw[i + 4] == 1 else p(raw[i:i + 5]) for i in range(len(raw) - 4)]
        assert r.ppl.perplexity == pytest.approx(float(np.exp(-np.mean(np.log(want)))), rel=1e-4)


def test_junk_of_repeated_words_goes(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(3, 8)))) for _ in range(300)]
    docs, labels = [], []
    for i in range(400):
        t = list(rng.choice(words, 60))
        if i % 50 == 7:  # a clean text may repeat a word
            t[20:27] = [t[20]] * 7
        if i % 8 == 0:
            t = [w for w in t[:25] for _ in range(int(rng.integers(10, 30)))]
        docs.append((i, " ".join(t), "en", "s", 0.0))
        labels.append((i, int(i % 8 != 0)))
    got = Q.quality(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert {r.doc_id for r in got if not r.keep} == set(range(0, 400, 8))


def test_without_labels_or_documents(spark):
    docs, _ = corpus(5)
    d = spark.createDataFrame(docs, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.keep for r in Q.quality(d, none).collect()] == [1] * 5
    assert Q.quality(d.limit(0), none).collect() == []
