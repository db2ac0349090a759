import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqscore.llm import raking as R


def brute_rake(cells, targets, rounds=200):
    """cells: {(a, b, c): tokens}; targets: one {value: share} for each place."""
    w = {k: 1.0 for k, t in cells.items() if t > 0}
    total = sum(t for t in cells.values())
    for _ in range(rounds):
        for i, shares in enumerate(targets):
            have = {}
            for k in w:
                have[k[i]] = have.get(k[i], 0) + w[k] * cells[k]
            for k in w:
                w[k] *= shares[k[i]] * total / have[k[i]]
    return w


def table(spark, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        s = ["hot", "b", None][int(rng.choice(3, p=[0.7, 0.2, 0.1]))]
        rows.append((i, "w " * int(rng.integers(1, 40)), str(rng.choice(["en", "fr"], p=[0.8, 0.2])), s, 9))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight int")


def test_weights_equal_plain_raking(spark):
    df = table(spark)
    got = R.mix(df, topic_of=F.when(F.col("doc_id") % 3 == 0, "x").otherwise("y")).collect()
    cells = {}
    for r in got:
        k = (r.mix_source, r.mix_lang, r.mix_topic)
        cells[k] = cells.get(k, 0) + r.mix_tokens
    targets = []
    for i in range(3):
        t = {}
        for k, n in cells.items():
            t[k[i]] = t.get(k[i], 0) + n
        s = {v: n ** 0.7 for v, n in t.items()}
        targets.append({v: x / sum(s.values()) for v, x in s.items()})
    want = brute_rake(cells, targets)
    for r in got:
        assert r.mix_weight == pytest.approx(want[(r.mix_source, r.mix_lang, r.mix_topic)], rel=2e-3)
    tokens = sum(r.mix_tokens for r in got)
    assert sum(r.mix_probability * r.mix_tokens for r in got) == pytest.approx(0.6 * tokens, rel=1e-6)
    rates = {(r.mix_probability / r.mix_weight) for r in got if r.mix_probability < 1}
    assert max(rates) - min(rates) < 1e-9 and all(0 < r.mix_probability <= 1 for r in got)


def test_sample_follows_the_probabilities(spark):
    df = table(spark, 3000)
    mixed = R.mix(df, fraction=0.4)
    rows = mixed.collect()
    for s in {r.mix_source for r in rows}:
        part = [r for r in rows if r.mix_source == s]
        want = sum(r.mix_probability for r in part)
        assert abs(sum(r.mix_sampled for r in part) - want) < 5 * len(part) ** 0.5
    again = {r.doc_id: r.mix_sampled for r in R.mix(df.orderBy(F.desc("doc_id")), fraction=0.4).collect()}
    assert again == {r.doc_id: r.mix_sampled for r in rows}


def test_given_targets_and_values_without_share(spark):
    df = table(spark)
    rows = R.mix(df, topic_of=F.lit("t"), targets={"source": {"hot": 1, None: 3}}).collect()
    weight = {}
    for r in rows:
        weight[r.mix_source] = weight.get(r.mix_source, 0) + r.mix_weight * r.mix_tokens
        if r.mix_source == "=b":
            assert (r.mix_weight, r.mix_sampled) == (0, 0)
    assert weight["null"] == pytest.approx(3 * weight["=hot"], rel=1e-3)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, "", "en", "null"), (None, "a b", "en", "null"),
                                (None, "a b", None, None), (3, "c", "en", "s"), (3, "c", "en", "s")],
                               "doc_id long, text string, lang string, source string")
    rows = R.mix(df, fraction=1.0).collect()
    assert len(rows) == 6 and rows[0].asDict().keys() >= {"doc_id", "text", "lang", "source"}
    assert [r.mix_sampled for r in rows if not r.mix_tokens] == [0, 0]
    assert len({r.mix_sampled for r in rows if r.doc_id == 3}) == 1
    assert R.mix(df.limit(0)).collect() == []
    assert R.mix(df.limit(2)).filter("mix_sampled = 1").collect() == []


def test_topics_and_no_python(spark):
    df = spark.createDataFrame([("All rights reserved.",), ("see http://x",), ("a@b.c",), ("def f(): {}",), ("x",),
                                ("w " * 3000,), ("w " * 300,), (None,), (" ",)], "text string")
    got = [r[0] for r in df.select(R.topic(F.col("text"))).collect()]
    assert got == ["rights", "links", "contact", "code", "short", "long", "prose", "empty", "empty"]
    plan = R.mix(table(spark, 20))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_window_gathers_the_cells_of_a_value(spark, monkeypatch):
    plans, cut = [], R.cut_lineage

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(R, "cut_lineage", noted)
    R.mix(table(spark, 50))
    assert len(plans) > 2 and not any("Window" in p for p in plans)
