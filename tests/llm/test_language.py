import zlib

import numpy as np

from seqscore.llm import language as L

SOUNDS = {"aa": "ka ri to nu mela sopi".split(), "bb": "sch ung heit ver ein kraft".split(),
          "cc": "tion ment eau ique oir ette".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang], rng.integers(1, 4))) for _ in range(n))


def corpus(n=240, seed=0):
    rng = np.random.default_rng(seed)
    langs = [sorted(SOUNDS)[i % 3] for i in range(n)]
    return [(i, text(rng, lang, int(rng.integers(5, 60))), lang, "s", 0.1) for i, lang in enumerate(langs)]


SCHEMA = "doc_id long, text string, lang string, source string, score double"


def test_held_out_accuracy_and_edges(spark):
    rows = corpus()
    rows += [(1000, None, "aa", "s", 0.0), (1001, "12 34 !", "bb", "s", 0.0), (1002, "", None, "s", 0.0),
             (None, "melasopi torika", None, "s", 0.0), (5, rows[5][1], None, "s", 0.0),
             (1003, "kari\x00 tonu \x00 mela", None, "s", 0.0), (1004, "ver" * 5000, None, "s", 0.0)]
    got = L.language_id(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 1000}
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0)
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.languages) == ("und", [])
        elif r.doc_id in lang and r.held_out and r.doc_id != 5:
            assert r.lang_pred == lang[r.doc_id]
    by = {r.doc_id: r.lang_pred for r in got}
    assert by[None] == by[1003] == "aa" and by[1004] == "bb"


def test_mixtures(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    model = L.train(df)
    rng = np.random.default_rng(9)
    one = text(rng, "bb", 60)
    both = text(rng, "aa", 60) + " " + text(rng, "cc", 30)
    (_, _, l1, p1), (name, score, l2, p2) = L.infer([one, both], model)
    assert l1 == ["bb"] and p1 == [1.0]
    assert (name, l2) == ("aa", ["aa", "cc"])
    assert abs(p2[0] - 2 / 3) < 0.1 and abs(sum(p2) - 1) < 1e-6 and score == p2[0]


def test_selection_equals_the_best_subset():
    """Backward elimination finds the set that trying all subsets finds."""
    from itertools import combinations
    rng = np.random.default_rng(4)
    for k in range(12):
        true = rng.choice(3, 40, p=[[1, 0, 0], [0.7, 0.3, 0], [0.4, 0.3, 0.3]][k % 3])
        ll = rng.normal(0, 1, (40, 3))
        ll[np.arange(40), true] += 6
        chosen, p = L.select_languages(ll, 2.0)
        like = np.exp(ll - ll.max(1, keepdims=True))
        best = max((L._proportions(like[:, list(s)], np.ones(40))[1] - 2 * np.log(41) * (n - 1), -n, s)
                   for n in (1, 2, 3) for s in combinations(range(3), n))
        assert tuple(chosen) == best[2] and abs(p.sum() - 1) < 1e-6


def test_trigrams_by_plain_counting():
    texts = ["Ab c", None, "", "é1x", "a\x00b"]
    bucket, word, doc = L.letter_trigrams(texts)
    assert doc.tolist() == [0, 0, 0, 3, 3, 4, 4]
    assert word.tolist() == [0, 0, 1, 2, 3, 4, 5]
    alone, _, _ = L.letter_trigrams(["c"])
    assert bucket[2] == alone[0]


def test_empty_and_unlabelled(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert L.language_id(none).collect() == []
    rows = L.language_id(spark.createDataFrame([(1, "abc", None, "s", 0.0)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
