"""Fill-in-the-middle: every row against a plain version, odd texts, bounds."""

import hashlib
import random
import re

import numpy as np
import pytest

from seqscore.llm import fill_in_middle as M
from seqscore.llm.queries import ORACLE_SQL, op12_fill_in_middle

SF = "/root/testdata/sf0.001"
UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, rate=50, spm_rate=80, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    assert "".join(units) == text
    n = len(units)
    if not text or any(m in text for m in M.MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def check(spark, rows, **options):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    out = M.fill_in_middle(df, **options).select("*", M.restored(F.col("fim.output"), F.col("fim.form")).alias("back"))
    got = sorted((repr((r.doc_id, r.text)), tuple(r.fim), r.back) for r in out.collect())
    want = sorted((repr((i, t)), plain(i, t, **options), t or "") for i, t in rows)
    assert got == want


ODD = [None, "", " ", "\n\t ", "a", " a", "a ", "a b", "  a  b  ", "x<P>y", "<S>", "a <M>", "<", "<P", "P> <", "a< S>b", "é ü 漢字 🙂",
       " a b c", "\x1c\x1d a\x00b", "a\r\nb\x0bc\x0cd", "<P <S <M"]


@pytest.mark.parametrize("rate", [0, 50, 100])
def test_odd_texts(spark, rate):
    check(spark, [(i, t) for i in [None, *range(25)] for t in ODD], rate=rate)


def test_random_texts_repeats_and_ties(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(50), "".join(rng.choice("ab é<P>SM \t\n") for _ in range(rng.randrange(60)))) for _ in range(600)]
    check(spark, rows + rows[:50], rate=90, spm_rate=50)


def test_long_texts_and_small_windows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}é" for i in range(50)]
    long = " ".join(words[i] for i in rng.integers(0, 50, 900_000))      # longer than a block
    check(spark, [(i, long) for i in range(4)] + [(9, "short one"), (10, long[:3_000_000])], rate=100)


def test_displacements_do_not_depend_on_blocks_and_windows(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é \n") for _ in range(rng.randrange(80))) for _ in range(200)]
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    draws = [np.array([rng.randrange(1 << 32) for _ in texts]) for _ in range(4)]
    marks = tuple(m.encode() for m in M.MARKS)
    data = np.frombuffer(raw, np.uint8)
    whole = M._transform(data, offsets, draws, 80, 50, marks)
    monkeypatch.setattr(M, "WINDOW", 7)
    small = M._transform(data, offsets, draws, 80, 50, marks)
    for a, b in zip(whole, small, strict=True):
        assert (a == b).all()
    back, ends = M._restore(small[4], small[5], small[1], marks)
    assert back.tobytes() == raw and (ends == offsets).all()


def test_outputs_without_marks_fail():
    with pytest.raises(ValueError, match="marks"):
        M._restore(np.frombuffer(b"<P>a<S>b", np.uint8), np.array([0, 8]), np.array([1]), (b"<P>", b"<S>", b"<M>"))


def test_other_columns_stay_and_names_may_not_clash(spark):
    df = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n long, output string")
    out = M.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "n", "output", "fim"] and out.collect()[0].n == 7
    with pytest.raises(ValueError, match="fim"):
        M.fill_in_middle(out)
    assert M.fill_in_middle(df.limit(0)).count() == 0


def test_query_matches_sql(spark):
    from seqscore.plans.check import duck_views
    got = op12_fill_in_middle(spark, SF)
    cols = got.columns
    rel = duck_views(SF).execute(ORACLE_SQL["op12_fill_in_middle"])
    names = [d[0] for d in rel.description]
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in rel.fetchall())
    assert sorted(map(tuple, got.collect())) == want
