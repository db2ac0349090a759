"""Scoring expressions: residue lookups, the cyclic penalty, the
composite score and the agreement label (all native Column expressions)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.config import ScoringConfig


def literal_map(mapping: dict) -> Column:
    """A literal MAP column; folded to a constant by Catalyst."""
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def eisenberg(resname: Column) -> Column:
    """Scale value for a three-letter residue name; unknown residues weigh 0."""
    return F.coalesce(F.try_element_at(literal_map(C.EISENBERG), resname), F.lit(0.0))


def charge_class(resname: Column) -> Column:
    """+1 for ARG/LYS, -1 for ASP/GLU, 0 otherwise (HIS is neutral)."""
    return (F.when(resname.isin(*C.POSITIVE_RESIDUES), F.lit(1))
            .when(resname.isin(*C.NEGATIVE_RESIDUES), F.lit(-1))
            .otherwise(F.lit(0)))


def cyclic_penalty(dist_nc: Column, cfg: ScoringConfig) -> Column:
    """1.0 when the ends are further apart than the threshold (strict)."""
    return F.when(dist_nc > F.lit(cfg.cyclicity_penalty_threshold), F.lit(1.0)).otherwise(F.lit(0.0))


def cyclic_candidate(dist_nc: Column, cfg: ScoringConfig) -> Column:
    """Strictly closer than the threshold (at equality: neither flag)."""
    return dist_nc < F.lit(cfg.cyclicity_penalty_threshold)


def composite_score(net_charge: Column, muh: Column, plddt: Column, dist_nc: Column,
                    cfg: ScoringConfig) -> Column:
    """charge*anionic + muH*weight + mean pLDDT - penalty*2."""
    return (net_charge * F.lit(cfg.anionic_fraction)
            + muh * F.lit(cfg.hydrophobic_moment_weight)
            + plddt
            - cyclic_penalty(dist_nc, cfg) * F.lit(C.CYCLIC_PENALTY_WEIGHT))


def agreement_label(rho: Column, n_valid: Column) -> Column:
    """Interpretation of a rank correlation; fewer than 3 rows is
    'Insufficient data'."""
    expr = F.when(n_valid < F.lit(C.MIN_CORRELATION_ROWS), F.lit(C.INSUFFICIENT_LABEL))
    for cut, label in C.AGREEMENT_LABELS:
        expr = expr.when(rho > F.lit(cut), F.lit(label))
    return expr.otherwise(F.lit(C.NO_AGREEMENT_LABEL))
