"""Summary reports (A7, A12-A15).  Each is one global or grouped
aggregate with partial (map-side) aggregation; exact order statistics come
from rounds of counting, without sorting or collecting values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqscore.functions.numeric import no_nan, round_dp
from seqscore.operators.ranking import one_row


def batch_summary(scored: DataFrame) -> DataFrame:
    """Count, cyclic candidates, multi-Cys (>= 2), mean pLDDT, score
    mean / min / max."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("cyclic_candidate")).alias("n_cyclic"),
        F.count_if(F.col("cys_count") >= 2).alias("n_multi_cys"),
        round_dp(F.avg("plddt"), 6).alias("mean_plddt"),
        round_dp(F.avg("score"), 6).alias("mean_score"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"))


def margin_stats(pairs: DataFrame) -> DataFrame:
    """Margin min / max / mean over the preference pairs."""
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.min("margin").alias("min_margin"), F.max("margin").alias("max_margin"),
                     round_dp(F.avg("margin"), 6).alias("mean_margin"))


def reject_diversity(pairs: DataFrame) -> DataFrame:
    """Distinct chosen / rejected ids and the most used reject's share.
    ``count(DISTINCT)`` is planned as a two-phase aggregation; the top reject
    comes from a per-reject count (partial aggregation), never a collect."""
    per_reject = pairs.groupBy("rejected").agg(F.count(F.lit(1)).alias("_n"))
    top = per_reject.agg(F.max_by(F.struct("rejected", "_n"), F.struct("_n", F.col("rejected"))).alias("_top"))
    base = pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.count_distinct("chosen").alias("n_distinct_chosen"),
                     F.count_distinct("rejected").alias("n_distinct_rejected"))
    t = one_row(top.select("_top.rejected", "_top._n"))
    top_id, top_n = (t["rejected"], t["_n"]) if t is not None else (None, None)
    return base.select("n_pairs", "n_distinct_chosen", "n_distinct_rejected",
                       F.lit(top_id).cast(pairs.schema["rejected"].dataType).alias("top_reject"),
                       round_dp(F.lit(top_n).cast("bigint") / F.col("n_pairs"), 6).alias("top_reject_share"))


SELECT_BUCKETS = 4096


def order_statistics(df: DataFrame, col: str, places: list[int], buckets: int = SELECT_BUCKETS) -> dict[int, float]:
    """Values at the 0-based ``places`` of the sorted column, NULL and NaN left
    out, without sorting it.

    Rounds of counting: every range that holds a wanted place is cut into
    ``buckets`` equal parts, one partial aggregation counts the rows of all
    parts and takes their least and greatest value, and the parts that hold a
    place are the next ranges.  Least and greatest value of a range fall into
    different parts, so each round narrows; a part of one value is done,
    however many rows share it.  A round sends at most ranges x buckets rows to
    the driver, and a place costs about one round for each factor of 4096
    between the range and the distance of its neighbours."""
    v = no_nan(col).cast("double")
    values = df.select(v.alias("_v")).filter("_v is not null")
    lo, hi, n = values.agg(F.min("_v"), F.max("_v"), F.count(F.lit(1))).first()
    for k in places:
        if not 0 <= k < n:
            raise IndexError(f"place {k} of {n} values")
    found: dict[int, float] = {}
    # (least, greatest, rows before) -> places wanted
    ranges = {(lo, hi, 0): sorted(set(places))}
    while True:
        for (a, b, _), wanted in list(ranges.items()):
            if a == b:
                found.update(dict.fromkeys(wanted, a))
                del ranges[a, b, _]
        if not ranges:
            return found
        part = range_id = None
        for i, (a, b, _) in enumerate(ranges):
            inside = F.col("_v").between(F.lit(a), F.lit(b))
            # halves keep the width of a range finite; infinite ends are parts of their own
            cut = F.lit(1) if math.isinf(a) or math.isinf(b) else F.floor(
                (F.col("_v") / 2 - F.lit(a / 2)) / F.lit(b / 2 - a / 2) * F.lit(float(buckets))).cast("long")
            cut = F.when(F.col("_v") == F.lit(a), F.lit(0)).when(F.col("_v") == F.lit(b), F.lit(buckets)).otherwise(cut)
            part = F.when(inside, cut) if part is None else part.when(inside, cut)
            range_id = F.when(inside, F.lit(i)) if range_id is None else range_id.when(inside, F.lit(i))
        counted = (values.select("_v", range_id.alias("_range"), part.alias("_part")).filter("_range is not null")
                   .groupBy("_range", "_part").agg(F.min("_v"), F.max("_v"), F.count(F.lit(1))).collect())
        narrowed: dict[tuple, list[int]] = {}
        for i, ((_, _, before), wanted) in enumerate(ranges.items()):
            for _, _, least, most, rows in sorted((r for r in counted if r[0] == i), key=lambda r: r[1]):
                here = [k for k in wanted if before <= k < before + rows]
                if here:
                    narrowed[least, most, before] = here
                before += rows
        ranges = narrowed


def exact_percentile(df: DataFrame, col: str, q: float) -> float | None:
    """Exact linear-interpolation percentile (``percentile_cont``) from the two
    neighbouring order statistics; None for an input without values."""
    n = df.filter(no_nan(col).isNotNull()).count()
    if n == 0:
        return None
    h = (n - 1) * float(q)
    lo, hi = math.floor(h), math.ceil(h)
    v = order_statistics(df, col, [lo, hi])
    return v[lo] + (h - lo) * (v[hi] - v[lo])


def above_percentile(df: DataFrame, cohort_col: str, base: str, other: str, q: float,
                     col: str) -> DataFrame:
    """Rows of cohort ``other`` above the ``q`` percentile of cohort
    ``base`` (e.g. generated sequences above the original 90th)."""
    p = exact_percentile(df.filter(F.col(cohort_col) == base), col, q)
    pl = F.lit(p).cast("double")
    o = df.filter(F.col(cohort_col) == other)
    return o.agg(F.count(F.lit(1)).alias("n_other"),
                 F.count_if(F.col(col) > pl).alias("n_above")).select(
        "n_other", "n_above", round_dp(pl, 6).alias("threshold"))


def histogram(df: DataFrame, col: str, by: list[str], buckets: int) -> DataFrame:
    """Equal-width buckets over the global [min, max] (1..buckets; the
    maximum falls in the last bucket), counted per group."""
    rng = one_row(df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")))
    lo, hi = F.lit(rng["lo"]).cast("double"), F.lit(rng["hi"]).cast("double")
    b = F.when(hi > lo, F.least(F.lit(buckets).cast("bigint"), (F.floor(
        (F.col(col) - lo) / (hi - lo) * F.lit(float(buckets))) + 1).cast("bigint"))).otherwise(F.lit(1).cast("bigint"))
    return df.withColumn("bucket", b).groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("n"))
