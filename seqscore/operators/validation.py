"""Physics-validation side.

Energies and relaxed coordinates are computed elsewhere; they enter here
as tables and are joined to the scored candidates.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.functions.numeric import exact_sum, least_first, no_nan, round_dp, score_key
from seqscore.functions.scoring import agreement_label
from seqscore.operators.ranking import global_rank
from seqscore.session import cut_lineage
from seqscore.sources.files import ATOM_KEY

IDENTITY = ["id", "proxy_score", "plddt", "dist_nc", "muH", "net_charge"]


def energy_rows(candidates: DataFrame, key: str = "seq_idx") -> DataFrame:
    """Per candidate ``delta_e`` (unrounded difference, rounded
    to 2 dp like the energies) and ``converged`` (|delta| > 0.1; false for
    failed runs, whose energies are NULL).

    ``candidates``: key, id, score, plddt, dist_nc, muH, net_charge,
    e_initial, e_final (NULL = failed).
    """
    # NaN (a failed run written by pandas) is the same as NULL here
    e0, e1 = no_nan("e_initial"), no_nan("e_final")
    d = e1 - e0
    return candidates.select(
        key, "id", F.col("score").alias("proxy_score"), "plddt", "dist_nc", "muH", "net_charge",
        round_dp(e0, 2).alias("e_initial"),
        round_dp(e1, 2).alias("e_final"),
        round_dp(d, 2).alias("delta_e"),
        F.coalesce(F.abs(d) > F.lit(C.CONVERGENCE_DELTA), F.lit(False)).alias("converged"))


def rank_validation(rows: DataFrame, key: str = "seq_idx") -> DataFrame:
    """``rank_proxy`` (score desc) and ``rank_physics`` (e_final
    asc) among succeeded rows, merged back by key; failures get NULL ranks.
    With fewer than three succeeded rows: proxy rank over all rows in
    candidate order and no physics rank.

    The ranks are chained with all columns carried, both taking their ranges
    from the pinned rows, so nothing is merged back by a join and nothing but the
    input is pinned; failures are added at the end (U1).
    """
    rows = cut_lineage(rows)
    ok = rows.filter(F.col("e_final").isNotNull() & ~F.isnan("e_final"))
    none = F.lit(None).cast("bigint")
    n = ok.count()
    if n >= C.MIN_CORRELATION_ROWS:
        proxy = global_rank(ok, [score_key("proxy_score").desc_nulls_last(), F.col(key)], "rank_proxy", pin_input=False,
                            n_rows=n)
        both = global_rank(proxy, [least_first("e_final"), F.col(key)], "rank_physics", pin_input=False,
                           keys_from=ok, n_rows=n)
        failed = rows.filter(F.col("e_final").isNull() | F.isnan("e_final"))
        return both.unionByName(failed.withColumns({"rank_proxy": none, "rank_physics": none}))
    return global_rank(rows, [score_key("proxy_score").desc_nulls_last(), F.col(key)], "rank_proxy",
                       pin_input=False).withColumn("rank_physics", none)


PVALUE_STEPS = 400


def t_test_pvalue(rho: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation coefficient from ``n`` pairs, by
    Student's t with nu = n - 2 degrees of freedom; NULL below 3 pairs, 0 at
    |rho| = 1.

    With t = sqrt(nu) tan(theta), theta = asin |rho|, the density becomes
    cos(theta)^(nu - 1), so p = 1 - I(theta) / I(pi / 2), I being its integral
    from 0.  Beyond 12 / sqrt(nu) the integrand is below 1e-31 of its peak;
    Simpson's rule with a fixed number of steps up to there serves every n."""
    nu = (n - 2).cast("double")
    top = F.least(F.lit(math.pi / 2), F.lit(12.0) / F.sqrt(nu))
    theta = F.least(F.asin(F.abs(rho)), top)

    def area(upto: Column) -> Column:
        def term(acc, k):
            weight = F.when(k % (2 * PVALUE_STEPS) == 0, 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
            # 2 * PVALUE_STEPS intervals
            return acc + weight * F.exp((nu - 1) * F.log(F.cos(upto * k / (2.0 * PVALUE_STEPS))))
        return upto * F.aggregate(F.sequence(F.lit(0), F.lit(2 * PVALUE_STEPS)), F.lit(0.0), term)

    p = F.lit(1.0) - area(theta) / area(top)
    return (F.when(n < 3, F.lit(None).cast("double")).when(F.abs(rho) >= 1.0, F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))))


def _correlation_aggs() -> list[Column]:
    ok = F.col("rank_physics").isNotNull()
    return [F.count(F.lit(1)).alias("n_total"),
            F.count_if(ok).alias("n_validated"),
            F.corr(F.when(ok, F.col("rank_proxy").cast("double")),
                   F.when(ok, F.col("rank_physics").cast("double"))).alias("_rho")]


def _correlation_cols() -> list[Column]:
    enough = F.col("n_validated") >= C.MIN_CORRELATION_ROWS
    rho = F.when(enough, F.coalesce(F.col("_rho"), F.lit(0.0))).otherwise(F.lit(0.0))
    pval = F.when(enough, t_test_pvalue(F.col("_rho"), F.col("n_validated"))).otherwise(F.lit(1.0))
    return [F.col("n_validated"), F.col("n_total"),
            round_dp(rho, 4).alias("spearman_rho"),
            round_dp(pval, 4).alias("spearman_pval"),
            agreement_label(rho, F.col("n_validated")).alias("interpretation")]


def rank_correlation(ranked_rows: DataFrame) -> DataFrame:
    """One row ``n_validated, n_total, spearman_rho, spearman_pval,
    interpretation``.  Ranks are a permutation, so Spearman's rho is the
    Pearson correlation of the two rank columns (one global aggregate,
    partial per partition).  Fewer than three succeeded rows: rho 0.0,
    p 1.0, 'Insufficient data'."""
    return ranked_rows.agg(*_correlation_aggs()).select(*_correlation_cols())


def validation_summary(ranked_rows: DataFrame, key: str = "seq_idx", best: str = "proxy_score") -> DataFrame:
    """A8/A9/K3 content in one global aggregate: correlation, forcefield
    label, best proxy (highest proxy score), best physics (lowest e_final)
    and the mean of the rounded delta_e over succeeded rows (2 dp; NULL
    when none succeeded)."""
    ok = F.col("e_final").isNotNull()
    agg = ranked_rows.agg(
        *_correlation_aggs(),
        F.max_by("id", F.struct(score_key(best), -F.col(key))).alias("best_proxy"),
        F.min_by(F.when(ok, F.col("id")), F.when(ok, F.struct(F.col("e_final"), F.col(key)))).alias("best_physics"),
        F.avg(F.when(ok, F.col("delta_e"))).alias("_mean_de"))
    return agg.select(
        *_correlation_cols(),
        F.lit(C.FORCEFIELD_LABEL).alias("forcefield"), "best_proxy", "best_physics",
        round_dp(F.col("_mean_de"), 2).alias("mean_delta_e"))


REPORT = ["rank_physics", "rank_proxy", "sequence", "e_final", "delta_e", "rmsd", "plddt"]


def report(rows: DataFrame, *keys: str) -> DataFrame:
    """The succeeded rows as the ranked report shows them: both ranks,
    sequence, final energy, its change, RMSD and pLDDT; ``keys`` in front."""
    return rows.filter(F.col("e_final").isNotNull()).select(*keys, *REPORT)


def displacement(before: DataFrame, after: DataFrame, key: str = "id",
                 atom_key: tuple[str, ...] = ATOM_KEY) -> DataFrame:
    """Atoms of two structures aligned by ``atom_key`` (model,
    chain, residue number, insertion code, atom name), in whatever order the
    files hold them.  One row per structure of either side:

    key, n_atoms and rmsd (``sqrt(mean squared displacement)`` without
    superposition, 3 dp) over all atoms, n_missing and n_added (atoms of one
    side only), error.  A structure whose sides differ, name an atom twice or
    lack a coordinate has NULL ``n_atoms`` and ``rmsd`` and its ``error``; the
    others go on.  NULL parts of a key are equal; structures whose key is NULL
    are one.

    Both sides meet by one exchange on (structure, atom), which is unique and
    can't skew; per-structure sums are pre-aggregated and do not depend on
    their order."""
    def side(df: DataFrame, is_after: int) -> DataFrame:
        return df.select(key, *atom_key, F.lit(is_after).alias("_after"), *(no_nan(c).alias(c) for c in "xyz"))

    on = F.col("_after") == 1
    one = lambda c, s: F.max(F.when(s, F.col(c)))
    atoms = side(before, 0).unionByName(side(after, 1)).groupBy(key, *atom_key).agg(
        F.count_if(~on).alias("_a"), F.count_if(on).alias("_b"),
        *(one(c, ~on).alias(f"_{c}0") for c in "xyz"), *(one(c, on).alias(f"_{c}1") for c in "xyz"))
    d2 = sum((F.pow(F.col(f"_{c}1") - F.col(f"_{c}0"), 2) for c in "xyz"), F.lit(0.0))
    both = (F.col("_a") > 0) & (F.col("_b") > 0)
    agg = atoms.groupBy(key).agg(
        F.count_if(both).alias("_n"), F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"),
        F.count_if(F.col("_b") == 0).alias("n_missing"), F.count_if(F.col("_a") == 0).alias("n_added"),
        F.count_if((F.col("_a") > 1) | (F.col("_b") > 1)).alias("_twice"),
        F.count_if(both & d2.isNull()).alias("_blank"), exact_sum(F.when(both, d2)).alias("_d2"))
    count = lambda c: F.col(c).cast("string")
    error = (F.when(F.col("_na") == 0, F.lit("no atoms before"))
             .when(F.col("_nb") == 0, F.lit("no atoms after"))
             .when(F.col("_twice") > 0, F.concat(count("_twice"), F.lit(" atoms named twice")))
             .when(F.col("n_missing") + F.col("n_added") > 0, F.concat(
                 F.lit("atoms differ: "), count("n_missing"), F.lit(" missing, "), count("n_added"), F.lit(" added")))
             .when(F.col("_blank") > 0, F.concat(count("_blank"), F.lit(" atoms without coordinates"))))
    return agg.withColumn("error", error).select(
        key, F.when(F.col("error").isNull(), F.col("_n")).alias("n_atoms"),
        F.when(F.col("error").isNull(), round_dp(F.sqrt(F.col("_d2") / F.col("_n")), 3)).alias("rmsd"),
        "n_missing", "n_added", "error")


def rmsd(before: DataFrame, after: DataFrame, key: str = "seq_idx", pos: str = "ord") -> DataFrame:
    """``displacement`` with atoms paired by their position in the structure:
    key, rmsd, n_atoms, error."""
    return displacement(before, after, key, (pos,)).select(key, "rmsd", "n_atoms", "error")
