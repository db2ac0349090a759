import numpy as np
import pytest

from seqscore.llm.metric_join import range_join


def brute(rows, cosine):
    ok = []
    for _, v in rows:
        a = None if v is None or any(x is None for x in v) else np.asarray(v, np.float64)
        ok.append(a if a is not None and a.size and np.isfinite(a).all() and a.any() else None)
    unit = [None if a is None else a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max()) for a in ok]
    n = len(rows)
    link = [[i != j and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j])
             and bool(np.array_equal(ok[i], ok[j]) or unit[i] @ unit[j] >= cosine) for j in range(n)] for i in range(n)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(n):
            if link[i][j]:
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return sorted((str(k), sum(link[i]), str(low.get(find(i)))) for i, (k, _) in enumerate(rows))


def vectors(seed, n=160, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    rows = []
    for i in range(n):
        c = centres[rng.integers(9)]
        rows.append((i * 7 % 1009, (c + rng.normal(0, rng.choice([0.02, 0.2, 1.0]), dim)).tolist()))
    rows += [(2000 + i, list(rows[3][1])) for i in range(25)]  # copies
    rows += [(3000, [2 * x for x in rows[3][1]]), (3001, [-x for x in rows[3][1]])]
    return rows


@pytest.mark.parametrize("cosine,kind,block,pivots", [
    (0.95, "float", 2048, 2048), (0.95, "double", 16, 8), (0.9, "float", 8, 40), (1.0, "double", 16, 3), (0.3, "double", 64, 5)])
def test_links_and_components_equal_brute_force(spark, cosine, kind, block, pivots):
    rows = vectors(block)
    if kind == "float":
        rows = [(k, np.asarray(v, np.float32).astype(float).tolist()) for k, v in rows]
    if cosine == 1.0:
        rows = [r for r in rows if r[0] < 3000]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], f"vec_id long, embedding array<{kind}>, node int, cell int")
    got = range_join(df, min_cosine=cosine, block=block, max_pivots=pivots).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows, cosine)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_unusable_vectors_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
            (8, [1.0, 0.0]), (8, [1.0, -0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.001]), (10, [1e300, 1e298]),
            (11, [1e-300, 1e-302]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = range_join(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows, 0.95)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert range_join(df).collect() == []
    only = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in range_join(only).collect()] == [(1, 0, 1, True)]
