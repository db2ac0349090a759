import zlib

import numpy as np

from seqscore.llm.toxicity import FactorizationMachine, fit, fit_calibrated, hashed_terms, informative, toxicity


def test_pairwise_weights_are_learned():
    """Neither term alone is toxic, both together are: no additive weights can
    tell, the factors can."""
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        noise = rng.choice(np.arange(10, 40), 5, replace=False)
        rows.append(np.unique(np.concatenate([noise, [1] if a else [], [2] if b else []]).astype(np.int64)))
        y.append(int(a and b))
    m = fit(rows, np.array(y))
    p = m.scores([np.array([1]), np.array([2]), np.array([1, 2]), np.array([20]), np.zeros(0, np.int64)])
    assert p[2] > 0.7 and max(p[0], p[1], p[3], p[4]) < 0.5
    again = FactorizationMachine.from_bytes(m.to_bytes())
    assert np.array_equal(again.scores(rows[:50]), m.scores(rows[:50]))


def test_logits_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = FactorizationMachine(np.arange(0, 20, 2), 0.3, rng.normal(size=10), rng.normal(size=(10, 3)))
    rows = [np.unique(rng.integers(0, 20, 8)) for _ in range(5)] + [np.zeros(0, np.int64)]
    for r, z in zip(rows, m.logits(rows), strict=True):
        at = [int(i) // 2 for i in r if i % 2 == 0]
        want = 0.3 + sum(m.weight[i] for i in at) + sum(
            m.factors[i] @ m.factors[j] for k, i in enumerate(at) for j in at[k + 1:])
        assert abs(z - want) < 1e-9


def test_informative_terms_equal_a_plain_count():
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(30) < 0.3).astype(np.int64) for _ in range(300)]
    y = np.array([float(3 in r or rng.random() < 0.1) for r in rows])
    got = set(informative(rows, y, 4, 6.0).tolist())
    for t in range(30):
        table = np.array([[sum((t in r) == i and v == j for r, v in zip(rows, y, strict=True)) for j in (0, 1)]
                          for i in (0, 1)], float)
        want = table.sum(1, keepdims=True) * table.sum(0) / len(y)
        gain = 2 * sum(a * np.log(a / e) for a, e in zip(table.ravel(), want.ravel(), strict=True) if a)
        assert (t in got) == (gain >= 6), t
    assert 3 in got


def test_calibrated_scores_mean_shares():
    """A term with which 60 % are toxic and one with which 5 % are: the scores
    are about these shares, whatever weight the classes had in the fit."""
    rng = np.random.default_rng(4)
    rows, y = [], []
    for _ in range(4000):
        odd = rng.random() < 0.2
        noise = rng.choice(np.arange(10, 200), 6, replace=False)
        rows.append(np.unique(np.concatenate([noise, [1 if odd else 2]]).astype(np.int64)))
        y.append(int(rng.random() < (0.6 if odd else 0.05)))
    m = fit_calibrated(rows, np.array(y))
    high, low = m.scores([np.array([1]), np.array([2])])
    assert abs(high - 0.6) < 0.08 and abs(low - 0.05) < 0.03


def test_terms():
    assert hashed_terms(None).tolist() == hashed_terms("").tolist() == hashed_terms(" . ,").tolist() == []
    assert hashed_terms("Word word, (word)").tolist() == hashed_terms("word").tolist()
    assert set(hashed_terms("abcd")) < set(hashed_terms("abcd abcdefg"))


def corpus(n=600):
    rng = np.random.default_rng(5)
    words = [f"wort{chr(97 + i % 26)}{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        t = list(rng.choice(words, 20))
        if i % 5 == 0:
            t[3], t[9] = "idiot", "scum"
        docs.append((i, " ".join(t), "en", 0.5))
        labels.append((i, int(i % 5 == 0)))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = corpus()
    docs += [(1000, None, "de", 0.0), (1001, "", None, 0.0), (None, "idiot scum", "en", 0.0),
             (5, "idiot scum again", "en", 0.0)]
    labels += [(1000, None), (None, 1), (7, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    got = toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
            if r.doc_id < 600 and r.held_out:
                assert r.predicted == int(r.doc_id % 5 == 0)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = ({r.doc_id: r.score for r in toxicity(d, spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
            for x in (labels, flipped))
    assert a == b


def test_rare_language_is_caught_at_the_threshold(spark):
    """A language with a fortieth of the labels, whose insults are compounds of
    one stem, is judged by the same threshold as the large one."""
    docs, labels = corpus(2000)
    rng = np.random.default_rng(8)
    for i in range(5000, 5120):
        t = [f"mot{chr(97 + k % 26)}{k}" for k in rng.integers(0, 60, 15)]
        if i % 3 == 0:
            t[2], t[7], t[9] = (f"vile{k}xx" for k in rng.integers(0, 5, 3))
        docs.append((i, " ".join(t), "fr", 0.5))
        labels.append((i, int(i % 3 == 0)))
    got = toxicity(spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"),
                   spark.createDataFrame(labels, "doc_id long, toxic int")).filter("held_out and doc_id >= 5000").collect()
    assert len(got) > 20 and all(r.predicted == int(r.doc_id % 3 == 0) for r in got)


def test_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in toxicity(d, none).collect()] == [0]
    assert toxicity(d.limit(0), none).collect() == []


def test_bound_holds_for_rows_too(spark):
    """An id may have any number of rows: no more than the bound are learned,
    so further rows of it beyond the bound change nothing."""
    from pyspark.sql import functions as F

    from seqscore.llm import toxicity as module
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = [(1, f"word{i} insult group") for i in range(300)] + [(2, f"kind words {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = docs.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(40)
    few, all_ = (module.train(d, labels, max_rows=40).to_bytes() for d in (drawn, docs))
    assert few == all_
