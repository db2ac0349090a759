"""Pairing operators: preference pairs (J4), the general nearest-value
join (J4), training triplets (J1) and stratified reject sampling (X1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.functions.numeric import no_nan
from seqscore.operators.ranking import one_row, winner_count
from seqscore.session import cut_lineage


def preference_pairs(ranked: DataFrame, fraction: float = C.WINNER_FRACTION,
                     id_col: str = "id", score_col: str = "score",
                     rank_col: str = "rank") -> DataFrame:
    """Each winner (top ``fraction`` by rank) paired with the loser whose
    score is nearest.

    Winners are exactly the first ``n`` ranks, so every loser scores at
    most every winner and the nearest loser is always rank ``n + 1``.  That
    one row is looked up once and attached to the winners as literals: no
    join, no pairs, no shuffle.  No losers -> no pairs.  The ranks are pinned:
    count, look-up and every reader of the pairs would rank anew.
    """
    ranked = cut_lineage(ranked.select(*dict.fromkeys([id_col, score_col, rank_col])))
    n_win = winner_count(ranked.count(), fraction)
    loser = one_row(ranked.filter(F.col(rank_col) == F.lit(n_win + 1))
                    .select(F.col(id_col).alias("id"), F.col(score_col).alias("score")))
    winners = ranked.filter(F.col(rank_col) <= F.lit(n_win))
    rej_type = ranked.schema[id_col].dataType
    if loser is None:
        return winners.select(F.col(id_col).alias("chosen"), F.lit(None).cast(rej_type).alias("rejected"),
                              F.lit(None).cast("double").alias("margin")).filter(F.lit(False))
    return winners.select(
        F.col(id_col).alias("chosen"),
        F.lit(loser["id"]).cast(rej_type).alias("rejected"),
        (F.col(score_col) - F.lit(loser["score"])).alias("margin"))


def nearest_join(left: DataFrame, right: DataFrame, key: str, by: list[str],
                 left_id: str, right_id: str, num_partitions: int | None = None) -> DataFrame:
    """For every left row, the right row (same ``by`` values) whose ``key``
    is nearest.  Ties: equal distance -> the lower right key; equal right
    keys -> the smaller right id.  Left rows with no right partner in their
    group get nulls, and so do left rows whose key or group value is null or
    NaN: as in any equi-join, null matches nothing.

    Output: ``by``, ``left_id``, ``left_key``, ``right_id``, ``right_key``.

    Plan (no per-group window, no pairs): right rows are first reduced to
    one per (by, key); both sides are unioned and range-partitioned on
    (by, key, side); inside each range partition a running ``last``
    (ascending and descending) finds the previous and next right row; the
    last/first right row of every partition is carried to later/earlier
    partitions through a P-row broadcast summary, so a group larger than
    a partition is handled exactly.
    """
    spark = left.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rtype = _struct_type(right, by, key, right_id)
    # One right row per (by, key): the smallest id wins equal keys.
    usable = F.lit(True)
    for c in (*by, key):
        usable = usable & F.col(c).isNotNull()
        if right.schema[c].dataType.typeName() in ("double", "float"):
            usable = usable & ~F.isnan(c)
    right = right.filter(usable)
    unmatched = left.filter(~F.coalesce(usable, F.lit(False)))
    left = left.filter(usable)
    r1 = right.groupBy(*by, key).agg(F.min(right_id).alias("_rid"))
    rstruct = F.struct(*[F.col(b).alias(f"_b{i}") for i, b in enumerate(by)],
                       F.col(key).alias("k"), F.col("_rid").alias("rid"))
    l_rows = left.select(*by, F.col(key), F.lit(1).alias("_side"), F.col(left_id).alias("_lid"),
                         F.lit(None).cast(rtype).alias("_r"))
    r_rows = r1.select(*by, F.col(key), F.lit(0).alias("_side"),
                       F.lit(None).cast(left.schema[left_id].dataType).alias("_lid"),
                       rstruct.alias("_r"))
    sort = [*[F.col(b) for b in by], F.col(key), F.col("_side")]
    u = (l_rows.unionByName(r_rows).repartitionByRange(p, *sort)
         .withColumn("_pid", F.spark_partition_id()))
    u = cut_lineage(u)
    # P-row summary: first/last right row of each partition, then the
    # nearest carried right row from earlier / later partitions.
    is_r = F.col("_side") == 0
    summ = u.groupBy("_pid").agg(F.min(F.when(is_r, F.col("_r"))).alias("_first_r"),
                                 F.max(F.when(is_r, F.col("_r"))).alias("_last_r"))
    w = Window.orderBy("_pid")
    carry = summ.select(
        "_pid",
        F.last("_last_r", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_prev"),
        F.first("_first_r", ignorenulls=True).over(
            w.rowsBetween(1, Window.unboundedFollowing)).alias("_carry_next"))
    part = ["_pid", *by]
    asc = Window.partitionBy(*part).orderBy(F.col(key), F.col("_side")).rowsBetween(
        Window.unboundedPreceding, 0)
    desc = Window.partitionBy(*part).orderBy(F.col(key).desc(), F.col("_side").desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    scanned = (u.withColumn("_prev_l", F.last("_r", ignorenulls=True).over(asc))
               .withColumn("_next_l", F.last("_r", ignorenulls=True).over(desc))
               .filter(F.col("_side") == 1)
               .join(F.broadcast(carry), "_pid", "left"))

    def same_group(r):
        if not by:
            return F.lit(True)
        cond = None
        for i, b in enumerate(by):
            c = r[f"_b{i}"] == F.col(b)
            cond = c if cond is None else cond & c
        return cond

    prev = F.coalesce(F.col("_prev_l"), F.when(same_group(F.col("_carry_prev")), F.col("_carry_prev")))
    nxt = F.coalesce(F.col("_next_l"), F.when(same_group(F.col("_carry_next")), F.col("_carry_next")))
    scanned = scanned.withColumns({"_p": prev, "_q": nxt})
    dp = F.abs(F.col(key) - F.col("_p.k"))
    dq = F.abs(F.col("_q.k") - F.col(key))
    pick = (F.when(F.col("_q").isNull(), F.col("_p")).when(F.col("_p").isNull(), F.col("_q"))
            .when(dq < dp, F.col("_q")).otherwise(F.col("_p")))
    found = scanned.select(*by, F.col("_lid").alias(left_id), F.col(key).alias("left_key"),
                           pick["rid"].alias(right_id), pick["k"].alias("right_key"))
    return found.union(unmatched.select(
        *by, left_id, key, F.lit(None).cast(right.schema[right_id].dataType),
        F.lit(None).cast(right.schema[key].dataType)))


def _struct_type(right: DataFrame, by: list[str], key: str, right_id: str):
    from pyspark.sql.types import StructField, StructType
    fields = [StructField(f"_b{i}", right.schema[b].dataType) for i, b in enumerate(by)]
    fields.append(StructField("k", right.schema[key].dataType))
    fields.append(StructField("rid", right.schema[right_id].dataType))
    return StructType(fields)


def training_triplets(pairs: DataFrame, sequences: DataFrame, on_missing: str = "null",
                      id_col: str = "id", seq_col: str = "sequence") -> DataFrame:
    """(prompt, chosen, rejected) sequences for each preference pair.

    Pair ids resolve to sequences by index (``seq_<n>`` -> row ``n``).
    ``on_missing``: ``null`` keeps the pair with a null sequence, ``drop``
    removes it, ``raise`` fails the job on the first unresolved id.

    Rejected ids repeat heavily (the nearest-loser rule gives every pair the
    same one).  Both look-ups are plain joins on the id: the side with the
    repeated id holds two ids a row, and adaptive execution splits it where
    it grows large; the sequence is sent to each split, never collected.
    """
    from seqscore.functions.sequence import parse_id
    seqs = sequences.select(parse_id(F.col(id_col)).alias("_idx"), F.col(seq_col).alias("_seq"))
    how = "inner" if on_missing == "drop" else "left"
    # pinned: pairs made with one literal reject would turn the join on it
    # into a nested loop
    p = cut_lineage(pairs).withColumns({"_ci": parse_id(F.col("chosen")), "_ri": parse_id(F.col("rejected"))})
    a = seqs.select(F.col("_idx").alias("_ci"), F.col("_seq").alias("chosen_sequence"))
    b = seqs.select(F.col("_idx").alias("_ri"), F.col("_seq").alias("rejected_sequence"))
    out = p.join(a, "_ci", how).join(b, "_ri", how)
    if on_missing == "raise":
        # assert_true returns NULL; tying it into an output column keeps the
        # check from being pruned away
        ok = F.assert_true(F.col("chosen_sequence").isNotNull() & F.col("rejected_sequence").isNotNull(),
                           F.lit("preference pair id has no sequence"))
        out = out.withColumn("chosen_sequence", F.when(ok.isNull(), F.col("chosen_sequence")))
    return out.select(F.lit(C.TRAINING_PROMPT).alias("prompt"),
                      F.col("chosen").alias("chosen_id"), F.col("rejected").alias("rejected_id"),
                      F.col("chosen_sequence").alias("chosen"),
                      F.col("rejected_sequence").alias("rejected"))


def minstd_hash(key: str, seed: int) -> Column:
    """Lehmer / MINSTD step on the key: a deterministic pseudo-random order
    any SQL engine computes identically in 64-bit integers."""
    m = 2147483647
    return ((F.col(key) + F.lit(seed)) % F.lit(m)) * F.lit(48271) % F.lit(m)


def stratified_pairs(ranked: DataFrame, fraction: float = C.WINNER_FRACTION, seed: int = 7,
                     id_col: str = "id", score_col: str = "score", rank_col: str = "rank",
                     key_col: str = "seq_idx") -> DataFrame:
    """Each winner gets a distinct reject, spread over the loser score range
    (roadmap item X1).

    Losers are cut into ``n_win`` contiguous rank bins (integer arithmetic
    on the global rank, no window); inside a bin the loser with the
    smallest ``minstd_hash(key, seed)`` is picked by a partial ``min_by``
    aggregation; winner ``i`` takes the pick of bin ``i`` (equi-join on the
    bin number).  Deterministic; with fewer losers than winners, the
    winners of empty bins get a NULL reject and margin.
    """
    n = ranked.count()
    n_win = winner_count(n, fraction)
    n_lose = n - n_win
    losers = ranked.filter(F.col(rank_col) > F.lit(n_win))
    pos = F.col(rank_col) - F.lit(n_win)
    # bin = floor((pos - 1) * n_win / n_lose) + 1; exact in doubles below 2^53
    binned = losers.withColumn("_bin", (F.floor((pos - 1) * F.lit(n_win) / F.lit(max(n_lose, 1)))
                                        + 1).cast("bigint"))
    picks = binned.groupBy("_bin").agg(F.min_by(
        F.struct(F.col(id_col).alias("id"), F.col(score_col).alias("score")),
        F.struct(minstd_hash(key_col, seed).alias("h"), F.col(key_col).alias("k"))).alias("_pick"))
    winners = ranked.filter(F.col(rank_col) <= F.lit(n_win)).withColumn("_bin", F.col(rank_col))
    j = winners.join(picks, "_bin", "left")
    return j.select(F.col(id_col).alias("chosen"), F.col("_pick.id").alias("rejected"),
                    (F.col(score_col) - F.col("_pick.score")).alias("margin"),
                    F.col("_bin").alias("stratum"))
