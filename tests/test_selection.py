"""Order statistics by counting, and sums that do not depend on their order."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqscore.functions.numeric import exact_avg, exact_sum
from seqscore.operators import structure
from seqscore.operators.reports import exact_percentile, order_statistics

INF = float("inf")


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)


@pytest.mark.parametrize("seed", range(3))
def test_places_equal_sorting(spark, seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.uniform(-1, 1), lambda: 7.25, lambda: rng.gauss(0, 1) * 10.0 ** rng.randint(-300, 300),
             lambda: float(rng.randint(0, 3)), lambda: rng.choice([INF, -INF, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308])]
    values = [rng.choice(kinds[: 2 + seed * 2])() for _ in range(400)] + [7.25] * 200
    have = sorted(values)
    places = [0, 1, 57, 300, 301, len(have) // 2, len(have) - 2, len(have) - 1]
    got = order_statistics(column(spark, [*values, None, float("nan")]), "v", places, buckets=8 if seed else 4096)
    assert got == {k: have[k] for k in places}


def test_ties_and_single_values(spark):
    assert order_statistics(column(spark, [2.0] * 90 + [1.0] * 5), "v", [0, 4, 5, 94]) == {0: 1.0, 4: 1.0, 5: 2.0, 94: 2.0}
    assert order_statistics(column(spark, [3.5]), "v", [0]) == {0: 3.5}
    with pytest.raises(IndexError):
        order_statistics(column(spark, [1.0]), "v", [1])


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_percentile_interpolates(spark, q):
    rng = random.Random(9)
    values = [rng.gauss(0, 3) for _ in range(501)] + [0.25] * 250
    assert exact_percentile(column(spark, [*values, None]), "v", q) == pytest.approx(np.quantile(values, q), abs=1e-12)
    assert exact_percentile(column(spark, [None]), "v", q) is None


def test_selection_sorts_nothing(spark):
    """Every job of a selection is a partial aggregation: no range exchange."""
    df = column(spark, range(1000))
    before = {r.v for r in df.collect()}
    assert order_statistics(df, "v", [100])[100] == sorted(before)[100]
    plan = df.groupBy().agg(F.min("v"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def bits(x):
    return struct.pack("<d", x)


@pytest.mark.parametrize("partitions", [1, 7, 211])
def test_exact_sums_have_the_same_bits(spark, partitions):
    rng = random.Random(4)
    rows = [(i % 5, rng.uniform(-900, 900) * 10.0 ** rng.randint(-9, 0)) for i in range(3000)] + [(9, None)]
    want = {k: r for k, *r in map(tuple, spark.createDataFrame(rows, "k int, v double").coalesce(1).groupBy("k").agg(
        exact_sum(F.col("v")), exact_avg(F.col("v"))).collect())}
    rng.shuffle(rows)
    got = spark.createDataFrame(rows, "k int, v double").repartition(partitions).groupBy("k").agg(
        exact_sum(F.col("v")), exact_avg(F.col("v"))).collect()
    for k, *r in map(tuple, got):
        assert [x and bits(x) for x in r] == [x and bits(x) for x in want[k]]
        if k != 9:
            exact = sum(v for j, v in rows if j == k)
            assert r[0] == pytest.approx(exact, abs=1e-9)
    assert want[9] == [None, None]


def test_scores_have_the_same_bits_in_any_partitioning(spark):
    rng = random.Random(8)
    rows = [(s, i, rng.choice(["ALA", "ARG", "ASP", "LEU", "UNK"]), *(rng.uniform(-50, 50) for _ in range(3)), rng.random())
            for s in range(20) for i in range(rng.randint(1, 40))]
    schema = "seq_idx long, ord long, resname string, x double, y double, z double, plddt double"
    seen = set()
    for partitions in (1, 7, 211):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(partitions)
        got = structure.structure_metrics(df, ["seq_idx"], "ord").orderBy("seq_idx").collect()
        seen.add(tuple(tuple(bits(x) if isinstance(x, float) else x for x in r) for r in got))
    assert len(seen) == 1


def test_sum_of_one_value_is_the_value(spark):
    values = [0.1, -0.1, 1e-9, -3e-9, 12345.678, -0.0, 899.999, 5e5 / 3]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    assert {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()} == dict(enumerate(values))
    odd = spark.createDataFrame([(1, INF), (2, 1e300), (3, float("nan")), (3, 2.5)], "k int, v double")
    got = {r.k: r.s for r in odd.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert np.isnan(got[1]) and np.isnan(got[2]) and got[3] == 2.5
