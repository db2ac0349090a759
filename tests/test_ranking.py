"""Scalable rank and ordinal against window references."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seqscore.operators import ranking


def test_global_rank_equals_row_number_with_ties(spark):
    df = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("score"))
    got = ranking.global_rank(df, [F.col("score").desc(), F.col("k")], num_partitions=6)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("score").desc(), "k")))
    j = got.join(ref, "k")
    assert j.filter(F.col("rank") != F.col("ref")).count() == 0
    assert got.select("rank").distinct().count() == 500


def test_global_rank_single_value_all_rows(spark):
    df = spark.range(0, 300).select(F.col("id").alias("k"), F.lit(1.0).alias("score"))
    got = ranking.global_rank(df, [F.col("score").desc(), F.col("k")], num_partitions=5)
    assert sorted(r.rank for r in got.collect()) == list(range(1, 301))


def test_ordinal_within_hot_group_spanning_partitions(spark):
    hot = spark.range(0, 400).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    cold = spark.range(0, 30).select((F.col("id") % 5 + 2).alias("g"), F.col("id").alias("o"))
    df = hot.unionByName(cold)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    got = ranking.ordinal_within(df, ["g"], ["o"], "ord", num_partitions=7)
    j = got.join(ref, ["g", "o"])
    assert j.count() == 430
    assert j.filter(F.col("ord") != F.col("ref")).count() == 0


def test_missing_scores_rank_last(spark):
    from seqscore.functions.numeric import best_first, least_first, score_key
    nan = float("nan")
    df = spark.createDataFrame([(1, 0.5), (2, nan), (3, None), (4, 0.7), (5, 0.5000000001)], "k long, score double")
    for key, want in ((best_first("score"), [4, 5, 1]), (least_first("score"), [1, 5, 4]),
                      (score_key("score").desc_nulls_last(), [4, 5, 1])):
        got = sorted((r["rank"], r.k) for r in ranking.global_rank(df, [key, F.col("k")]).collect())
        assert [k for _, k in got] == want + [2, 3]
        assert [r.k for r in ranking.top_n(df, [key, F.col("k")], 4).collect()] == want + [2]


def test_split_partitions_input(spark):
    df = spark.range(1, 12).select(F.col("id").alias("k"), F.col("id").cast("double").alias("score"))
    r = ranking.global_rank(df, [F.col("score").desc(), F.col("k")])
    s = ranking.top_fraction_split(r, 0.2)
    win, lose = ranking.split(s)
    assert win.count() == 2 and lose.count() == 9      # int(11 * 0.2) = 2
    assert set(win.select("k").toPandas().k) == {11, 10}


def test_split_one_row_is_a_winner(spark):
    df = spark.createDataFrame([(1, 0.5)], "k long, score double")
    s = ranking.top_fraction_split(ranking.global_rank(df, [F.col("score").desc(), F.col("k")]), 0.2)
    assert s.collect()[0].is_winner


def test_top_n_plan_is_take_ordered(spark):
    df = spark.range(0, 100).select(F.col("id").alias("k"), (F.col("id") * 3 % 17).alias("score"))
    t = ranking.top_n(df, [F.col("score").desc(), F.col("k")], 5)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r.k for r in t.collect()] == [11, 28, 45, 62, 79]


def test_global_rank_on_unbalanced_input_partitions(spark):
    """One input partition holds most rows, which makes Spark re-sample it
    with an RDD-dependent seed; ranks must still be exact."""
    big = spark.range(0, 10000, 1, 1)
    small = spark.range(10000, 11500, 1, 15)
    df = big.unionByName(small).select(F.col("id").alias("k"), ((F.col("id") * 7919) % 1000).cast("double").alias("score"))
    got = ranking.global_rank(df, [F.col("score").desc(), F.col("k")], num_partitions=8).select("k", "rank")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("score").desc(), "k")))
    assert got.join(ref, "k").filter(F.col("rank") != F.col("ref")).count() == 0
    assert got.count() == 11500


def _mixed(spark):
    """Keys of several types, a third of the rows tied on all but the last."""
    i = F.col("id")
    third = i % 3 == 0
    return spark.range(0, 900, 1, 5).select(
        F.when(third, F.lit("same")).when(i % 11 != 0, F.concat(F.lit("ä\"\\"), (i % 37).cast("string"))).alias("s"),
        F.when(third, F.lit(None)).otherwise((i % 23).cast("decimal(38,12)") / 7).cast("decimal(38,12)").alias("d"),
        F.timestamp_micros(F.when(third, F.lit(5)).otherwise(1700000000000000 + i * 7919 % 50)).alias("t"),
        F.struct(F.when(i % 5 != 0, i % 2).alias("a"), F.lit(1.5).alias("b")).alias("o"),
        F.when(i % 13 == 0, F.lit(float("nan"))).otherwise(-i % 17 / 3.0).alias("f"), i.alias("k"))


ORDERS = [
    lambda: [F.col("s").desc_nulls_last(), F.col("t"), F.col("k").desc()],
    lambda: [F.col("d").desc_nulls_first(), F.col("o").desc(), "k"],
    lambda: [F.col("t").desc(), F.col("f").asc_nulls_last(), F.col("o"), F.col("k")],
    lambda: ["s", F.abs("f").desc(), F.col("d").asc_nulls_last(), F.col("k").desc()],
]


@pytest.mark.parametrize("number", range(len(ORDERS)))
def test_rank_and_ordinal_on_any_type_and_direction(spark, number):
    order = ORDERS[number]()
    df = _mixed(spark)
    want = {r.k: (r.n, r.m) for r in df.select(
        "k", F.row_number().over(Window.orderBy(*order)).alias("n"),
        F.row_number().over(Window.partitionBy("s").orderBy(*order)).alias("m")).collect()}
    rank = {r.k: r["rank"] for r in ranking.global_rank(df, order, num_partitions=9).collect()}
    ordinal = {r.k: r.ord for r in ranking.ordinal_within(df, ["s"], order, num_partitions=9).collect()}
    assert {k: (rank[k], ordinal[k]) for k in want} == want


def test_range_of_a_row_depends_on_its_key_alone(spark):
    """The bounds are literals: however the rows are dealt, also to other tasks
    after a loss, each falls into the same range and gets the same rank."""
    df = spark.range(0, 20000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 100).cast("double").alias("score"))
    order = [F.col("score").desc(), F.col("k")]
    seen = []
    for dealt in (df.repartition(1), df.repartition(13, "score"), df.repartition(40)):
        rows = dealt.withColumn("r", ranking.KeyRanges(dealt, order, 8).number())
        ranked = ranking.global_rank(rows, order, num_partitions=8, pin_input=False)
        seen.append(ranked.agg(F.sum(F.xxhash64("k", "r", "rank") % 1000003), F.max("r"), F.max("rank")).first())
    assert seen[0] == seen[1] == seen[2] and tuple(seen[0])[1:] == (7, 20000)
    sizes = [r["count"] for r in rows.groupBy("r").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_rank_writes_no_copy_of_its_own(spark):
    """With ``pin_input=False`` a rank reads its input's plan and pins nothing."""
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    for got in (ranking.global_rank(df, ["k"], pin_input=False),
                ranking.ordinal_within(df.withColumn("g", F.lit(1)), ["g"], ["k"], pin_input=False)):
        assert "ExistingRDD" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 1000


def test_ranks_of_an_empty_table(spark):
    df = spark.createDataFrame([], "g int, k long")
    assert ranking.global_rank(df, [F.col("k").desc()]).collect() == []
    assert ranking.ordinal_within(df, ["g"], ["k"]).collect() == []


def test_first_item_places_a_row_as_the_whole_key_does(spark):
    """NULL, NaN, both zeros, infinities and longs that share a double included."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [None, nan, -0.0, 0.0, inf, -inf, 1e300][i % 7] if i % 3 == 0 else i % 40 / 8 - 2,
             None if i % 11 == 0 else (1 << 60) + i % 90) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, f double, n long")
    for order in ([F.col("f").desc(), F.col("k")], [F.col("f").asc_nulls_last(), F.col("k")], [F.col("n").desc_nulls_first(), F.col("k")],
                  [F.col("n").asc(), F.col("k")], [F.expr("cast(k % 50 as decimal(38,12)) / 7").desc(), F.col("k")]):
        ranges = ranking.KeyRanges(df, order, 9)
        got = ranges.numbered(df.withColumn("want", ranges.number()))
        assert got.filter(~F.col("want").eqNullSafe(F.col(ranking._RANGE))).count() == 0
        assert got.select("want").distinct().count() > 5


def test_ordinals_place_only_rows_of_groups_at_bounds_twice(spark):
    """The counts behind the offsets read their groups' rows by a join, not by a
    search over the whole key of every row, once more for each bound."""
    df = spark.range(0, 3000).select((F.col("id") % 700).alias("g"), F.col("id").alias("o"))
    plan = ranking.ordinal_within(df, ["g"], ["o"], num_partitions=8, pin_input=False)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "aggregate(" in line]
