"""Per-structure geometry and the composite score (A1-A6, W5, F5-F8,
P8-P11), in two forms:

* relational: one row per CA atom, grouped by structure key.  Two
  steps (centroid, then everything else), each a partial (map-side)
  aggregation, so a huge structure is pre-reduced before its shuffle.
* array: one row per structure holding ``array<struct<resname,x,y,z,plddt>>``
  in file order, computed with higher-order functions and no shuffle at
  all (used by the file and streaming paths, where a file is one
  structure).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqscore.config import ScoringConfig
from seqscore.functions.numeric import distance3, exact_avg, exact_sum, no_nan, norm3, round_dp, safe_norm3
from seqscore.functions.scoring import (charge_class, composite_score, cyclic_candidate,
                                        eisenberg)
from seqscore.session import computed_once

METRIC_COLUMNS = ["n_res", "net_charge", "muH", "plddt", "dist_nc"]


def _missing(r) -> Column:
    """Whether an atom lacks a coordinate."""
    bad = None
    for axis in ("x", "y", "z"):
        b = r[axis].isNull() | F.isnan(r[axis])
        bad = b if bad is None else bad | b
    return bad


def _row(*names: str) -> dict:
    return {n: F.col(n) for n in names}


def centred_atoms(a: DataFrame, key: list[str]) -> DataFrame:
    """Atoms with their structure's centroid (``_cx, _cy, _cz``); structures
    with a missing coordinate are left out (see ``incomplete_structures``).

    One plan for every input: partial aggregation for the centroids, joined
    back by key; a structure with very many atoms is one skewed join key,
    which adaptive execution splits."""
    c = a.groupBy(*key).agg(
        *(exact_avg(F.col(c)).alias(f"_c{c}") for c in "xyz"),
        F.count_if(_missing(_row("x", "y", "z"))).alias("_missing")).filter("_missing = 0").drop("_missing")
    on = None
    for k in key:
        c = c.withColumnRenamed(k, f"_k_{k}")
        same = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        on = same if on is None else on & same
    return a.join(c, on).drop(*(f"_k_{k}" for k in key))


def incomplete_structures(atoms: DataFrame, key: list[str]) -> DataFrame:
    """Side table of the structures that are not scored: key, n_res and the
    number of atoms that lack a coordinate."""
    return atoms.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_res"),
        F.count_if(_missing(_row("x", "y", "z"))).alias("n_missing")).filter("n_missing > 0")


def structure_metrics(atoms: DataFrame, key: list[str], order: str) -> DataFrame:
    """``atoms``: key columns, ``order`` (any orderable column giving file
    order), ``resname``, ``x``, ``y``, ``z``, ``plddt``.

    Returns key + ``n_res, net_charge, muH, plddt, dist_nc`` (unrounded).
    Structures with no atoms (P7) or with a missing coordinate produce no
    row; a missing pLDDT is left out of its mean.  All per-structure
    quantities are partial (map-side) aggregates, so even a hot structure
    is pre-reduced before its shuffle; sums are exact, so the same atoms give
    the same bits in any order and partitioning.
    """
    a = atoms.select(*key, order, "resname", "x", "y", "z", "plddt")
    j = centred_atoms(a, key)
    dx, dy, dz = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy"), F.col("z") - F.col("_cz")
    nrm = safe_norm3(dx, dy, dz)
    h = eisenberg(F.col("resname"))
    xyz = F.struct(F.col("x").alias("x"), F.col("y").alias("y"), F.col("z").alias("z"))
    agg = j.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_res"),
        F.sum(charge_class(F.col("resname"))).alias("_charge"),
        exact_sum(dx / nrm * h).alias("_sx"), exact_sum(dy / nrm * h).alias("_sy"),
        exact_sum(dz / nrm * h).alias("_sz"),
        exact_avg(no_nan("plddt")).alias("plddt"),
        F.min_by(xyz, F.col(order)).alias("_first"),
        F.max_by(xyz, F.col(order)).alias("_last"))
    return agg.select(
        *key, "n_res",
        (F.col("_charge") / F.col("n_res")).alias("net_charge"),
        (norm3(F.col("_sx"), F.col("_sy"), F.col("_sz")) / F.col("n_res")).alias("muH"),
        "plddt",
        distance3(F.col("_first"), F.col("_last")).alias("dist_nc"))


def add_score(metrics: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """Composite score (P9-P11) and the ``cyclic_candidate`` flag (P10)."""
    return metrics.withColumns({
        "score": composite_score(F.col("net_charge"), F.col("muH"), F.col("plddt"),
                                 F.col("dist_nc"), cfg),
        "cyclic_candidate": cyclic_candidate(F.col("dist_nc"), cfg),
    })


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_dp(F.col(c), digits) for c in cols})


def score_structures(atoms: DataFrame, key: list[str], order: str, cfg: ScoringConfig) -> DataFrame:
    """Metrics + score, unrounded: outputs round (``rounded``), ranks don't."""
    return add_score(structure_metrics(atoms, key, order), cfg)


# ---------------------------------------------------------------------------
# Array form: one structure per row, no shuffle.
# ---------------------------------------------------------------------------

def structure_metrics_array(df: DataFrame, atoms_col: str = "atoms") -> DataFrame:
    """Same metrics from ``array<struct<resname,x,y,z,plddt>>`` (file order):
    one pass for the centroid, one that prepares each atom's direction and
    scale value, one that adds everything up."""
    arr = F.col(atoms_col)
    zero = F.lit(0.0)
    centre = F.aggregate(
        arr, F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z")),
        lambda s, r: F.struct(*((s[k] + r[k]).alias(k) for k in "xyz")))
    tmp = (computed_once(df, atoms_col).filter((F.size(arr) > 0) & ~F.exists(arr, _missing))
           .withColumns({"_n": F.size(arr), "_c": centre}))

    def towards(r):
        d = {k: r[k] - F.col("_c")[k] / F.col("_n") for k in "xyz"}
        return F.struct(*(v.alias(k) for k, v in d.items()), safe_norm3(d["x"], d["y"], d["z"]).alias("n"),
                        eisenberg(r["resname"]).alias("h"), charge_class(r["resname"]).alias("q"),
                        no_nan(r["plddt"]).alias("p"))

    def add(s, r):
        return F.struct(*((s[k] + r[k] / r["n"] * r["h"]).alias(k) for k in "xyz"),
                        (s["q"] + r["q"]).alias("q"), (s["p"] + F.coalesce(r["p"], zero)).alias("p"),
                        (s["m"] + F.when(r["p"].isNull(), 0).otherwise(1)).alias("m"))

    start = F.struct(*(zero.alias(k) for k in "xyz"), F.lit(0).alias("q"), zero.alias("p"), F.lit(0).alias("m"))
    tmp = tmp.withColumn("_s", F.aggregate(F.transform(arr, towards), start, add))
    first, last, s = F.element_at(arr, 1), F.element_at(arr, -1), F.col("_s")
    out = tmp.withColumns({
        "n_res": F.col("_n").cast("bigint"),
        "net_charge": s["q"] / F.col("_n"),
        "muH": norm3(s["x"], s["y"], s["z"]) / F.col("_n"),
        "plddt": F.when(s["m"] > 0, s["p"] / s["m"]),
        "dist_nc": norm3(first["x"] - last["x"], first["y"] - last["y"], first["z"] - last["z"]),
    })
    return out.drop("_n", "_c", "_s")


def scaled_plddt(df: DataFrame, scale: float, atoms_col: str = "atoms") -> DataFrame:
    """The array form with every pLDDT multiplied, for files that hold percent."""
    return df.withColumn(atoms_col, F.transform(atoms_col, lambda a: a.withField("plddt", a["plddt"] * scale)))


def incomplete_structures_array(df: DataFrame, atoms_col: str = "atoms") -> DataFrame:
    """Side table of the array form: structures without atoms or with a missing
    coordinate, with n_res and n_missing."""
    n = F.size(F.filter(F.col(atoms_col), _missing))
    return (df.withColumns({"n_res": F.size(atoms_col).cast("bigint"), "n_missing": n.cast("bigint")})
            .filter("n_res = 0 or n_missing > 0").select("id", "n_res", "n_missing"))
