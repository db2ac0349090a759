from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from seqscore.llm import quality, raking, simhash, toxicity
from test_simhash import components, print_of

WORDS = ["lorem", "ipsum", "dolor", "sit", "amet", "tempor", "magna", "aliqua", "labore", "velit", "nulla", "irure"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(240):
        t = list(rng.choice(WORDS, int(rng.integers(8, 60))))
        toxic, good = i % 8 == 1, i % 10 != 2
        if toxic:
            t[2:2] = ["idiot", "scum"]
        if not good:
            t = ["".join(rng.choice(list("#%&xqz"), 5)) for _ in t]
        rows.append((i, " ".join(t), ["en", "fr"][i % 2], f"s{i % 3}", len(" ".join(t)), "extra"))
        if i % 3:
            labels.append((i, int(good), int(toxic)))
    rows += [(300 + k, rows[5][1], "en", "s0", 1, "copy") for k in range(20)]
    rows += [(400, rows[7][1] + " .", "en", "s0", 1, None), (401, None, None, None, None, None), (402, "", "en", "s1", 0, "x"),
             (None, "magna aliqua sit", "en", "s1", 0, "x")]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string"
                          ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def ids(df):
    return Counter(r.doc_id for r in df.collect())


def test_stages_against_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "packing"]

    civil = P.keep_civil(spark, docs, tables)
    model = toxicity.train(docs, labels)
    want = Counter(r.doc_id for r in docs.collect()
                   if model.scores([toxicity.hashed_terms(r.text)])[0] < P.TOXIC_FROM)
    assert civil.columns == docs.columns and ids(civil) == want
    assert not any(i is not None and i < 240 and i % 8 == 1 and i % 10 != 2 for i in want)

    good = P.keep_good(spark, civil, tables)
    judged = quality.judged(civil, labels, quantile=P.QUALITY_QUANTILE, margin=P.QUALITY_MARGIN, prefix="q_").collect()
    assert good.columns == docs.columns
    assert ids(good) == Counter(r.doc_id for r in judged if r.q_lower is not None and r.q_lower <= r.q_threshold)
    assert all(i is None or i >= 240 or i % 10 != 2 for i in ids(good))
    assert len(good.collect()) >= 0.98 * sum(1 for i in want if i is None or i > 240 or i % 10 != 2) - 2

    first = P.keep_first_of_group(spark, good, tables)
    rows = [r for r in good.collect() if r.doc_id is not None]
    prints = {r.doc_id: print_of(r.text) for r in rows}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= P.MAX_DISTANCE]
    comp = components(prints, near)
    assert first.columns == docs.columns
    assert {i for i in ids(first) if i is not None} == {i for i in prints if comp[i] == i}
    assert simhash.near_duplicates(first).groupBy("component_id").count().filter("count > 1").count() == 0

    mixed = P.mix_sources(spark, first, tables)
    chosen = raking.mix(first, exponent=P.MIX_EXPONENT, fraction=P.MIX_FRACTION).filter("mix_sampled = 1")
    assert mixed.columns == docs.columns and ids(mixed) == ids(chosen)

    packed = P.pack_sequences(spark, mixed, tables).collect()
    assert {r.doc_id for r in packed} == set(ids(mixed))


def test_run_chains_the_stages(spark, tables):
    out = P.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, tables)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.select(*out.columns).collect()))


def test_empty_documents(spark, tables, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "x y z"), (9, "a b c d"), (9, "other text here now")]
    kept = P.keep_first_of_group(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert Counter(map(tuple, kept.collect())) == Counter([(5, "a b c d"), (None, "x y z"), (9, "other text here now")])


def test_columns_with_the_names_of_the_stages_pass_through(spark, docs_of):
    """The stages' own helper columns give way to those of the documents."""
    names = ["__row", "__lang", "__t", "__ppl", "__source", "__topic", "__mix_source", "__quality_keep", "tokens"]
    texts = ["the cat sat on the mat and looked at the dog", "a dog ran over the green hill to the river",
             "the cat sat on the mat and looked at the dog", "rain fell on the quiet village all night long"] * 6
    rows = [(i, f"{t} {i // 4}", "en", f"s{i % 3}", *(f"{n}-{i}" for n in names)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    docs = docs_of(rows, schema)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(24)], "doc_id long, quality int, toxic int")
    for out in (quality.keep_within(docs, labels), simhash.keep_first(docs, repeats=False),
                P.mix_sources(spark, docs, "")):
        assert out.columns == docs.columns
        for r in out.collect():
            assert tuple(r)[4:] == tuple(f"{n}-{r.doc_id}" for n in names)
