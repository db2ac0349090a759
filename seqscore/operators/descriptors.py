"""Per-sequence descriptors (U4 with F1-F4, P2 column append, P3 limit).

F1, F2 and F4 are row-local expressions (``seqscore.functions.sequence``).
F3, the dipeptide instability index, needs a 20x20 weight table:

    II = (10 / L) * sum_i w(s_i s_{i+1})

The published dipeptide weights are not available offline, so the table is
an input; without one the index is NULL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from seqscore import constants as C
from seqscore.functions import sequence as S
from seqscore.functions.numeric import no_nan


def dipeptide_counts(seqs: DataFrame, key: str = "seq_idx", seq_col: str = "sequence") -> DataFrame:
    """(key, dipeptide, n): overlapping dipeptide counts per sequence.

    Positions are exploded inside the task that holds the row and reduced
    by a partial aggregation on (key, dipeptide) before the shuffle, so at
    most 400 rows per sequence and partition cross the network."""
    s = F.col(seq_col)
    pos = seqs.select(key, F.explode(S.dipeptides(s)).alias("dipeptide"))
    return pos.groupBy(key, "dipeptide").agg(F.count(F.lit(1)).alias("n"))


# -- vectorised path: residue codes with numpy inside Arrow batches ----------

def _lut():
    lut = np.full(256, -1, dtype=np.int16)
    for i, aa in enumerate(C.AMINO_ACIDS):
        lut[ord(aa)] = i
    return lut


def _pair_codes(seq: str, lut):
    """Dipeptide codes 20*a+b of adjacent standard residues (bytes outside
    the twenty codes, including any non-ASCII byte, break the pair)."""
    c = lut[np.frombuffer(seq.encode("utf-8"), dtype=np.uint8)]
    a, b = c[:-1], c[1:]
    keep = (a >= 0) & (b >= 0)
    return (a[keep] * 20 + b[keep]).astype(np.int64)


def residue_profile(seq: F.Column, weights: list[float] | None) -> F.Column:
    """struct(counts, pair_sum) in one pass over each sequence (numpy on byte
    codes, Arrow batches): counts of the twenty residues in conventional
    order, and the sum of the dipeptide weights (NULL without weights)."""
    w = None if weights is None else np.asarray(weights, dtype=np.float64)

    @pandas_udf("counts array<int>, pair_sum double")
    def profile(s: pd.Series) -> pd.DataFrame:
        lut = _lut()
        counts, sums = [], []
        for text in s:
            if isinstance(text, str):
                c = lut[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]
                counts.append(np.bincount(c[c >= 0], minlength=20).astype(np.int32))
                sums.append(None if w is None else float(w[_pair_codes(text, lut)].sum()) if len(text) > 1 else 0.0)
            else:
                counts.append(None)
                sums.append(None)
        return pd.DataFrame({"counts": counts, "pair_sum": pd.Series(sums, dtype="float64")})

    return profile(seq)


def weight_vector(weights: DataFrame) -> list[float]:
    """Dense 400-vector from a (dipeptide, weight) table.  Only the 400
    standard dipeptides are kept, so the driver receives at most 400 rows."""
    valid = F.col("dipeptide").rlike(f"^[{C.AMINO_ACIDS}]{{2}}$")
    vec = [0.0] * 400
    for r in weights.filter(valid).select("dipeptide", "weight").collect():
        a, b = C.AMINO_ACIDS.index(r.dipeptide[0]), C.AMINO_ACIDS.index(r.dipeptide[1])
        vec[a * 20 + b] = float(r.weight or 0.0)
    return vec


def _index(pair_sum: F.Column, length: F.Column) -> F.Column:
    return F.when(length > 0, F.lit(10.0) * no_nan(pair_sum) / length)


def instability_index(seqs: DataFrame, weights: DataFrame | None = None, key: str = "seq_idx",
                      seq_col: str = "sequence") -> DataFrame:
    """(key, instability_index) = 10/L * sum of pair weights, from a (dipeptide,
    weight) table.  Dipeptides outside the table weigh 0; one residue gives
    0; empty sequences give NULL, and so do all without a table."""
    if weights is None:
        return seqs.select(key, F.lit(None).cast("double").alias("instability_index"))
    s = F.col(seq_col)
    return (seqs.select(key, F.length(s).alias("_L"), residue_profile(s, weight_vector(weights)).alias("_p"))
            .select(key, _index(F.col("_p.pair_sum"), F.col("_L")).alias("instability_index")))


def instability_index_native(seqs: DataFrame, weights: DataFrame, key: str = "seq_idx",
                             seq_col: str = "sequence") -> DataFrame:
    """Same result with built-in functions only: dipeptide rows exploded and
    joined to the broadcast weights, at most 400 rows (suits short peptides;
    long texts make one row per residue)."""
    counts = dipeptide_counts(seqs, key, seq_col)
    total = (counts.join(F.broadcast(weights), "dipeptide", "left")
             .groupBy(key).agg(F.sum(F.col("n") * F.coalesce(F.col("weight"), F.lit(0.0))).alias("_w")))
    L = F.length(F.col(seq_col))
    base = seqs.select(key, L.alias("_L"))
    return (base.join(total, key, "left")
            .select(key, _index(F.coalesce(F.col("_w"), F.lit(0.0)), F.col("_L")).alias("instability_index")))


def descriptors(seqs: DataFrame, weights: DataFrame | None = None, limit: int = 0,
                key: str = "seq_idx", seq_col: str = "sequence", ph: float = 7.4) -> DataFrame:
    """All input columns plus ``hydrophobicity, charge, instability_index,
    isoelectric_point`` (P2: appended, input columns kept).  ``limit`` > 0
    keeps rows with ``key < limit`` (P3, deterministic first-n).

    One projection: residue counts and the sum of pair weights come from a
    single Arrow pass, the formulas (mean hydropathy, Henderson-Hasselbalch
    charge, bisection pI) are native expressions over them."""
    if limit and limit > 0:
        seqs = seqs.filter(F.col(key) < F.lit(limit))
    s = F.col(seq_col)
    wv = None if weights is None else weight_vector(weights)
    tmp = seqs.withColumns({"_p": residue_profile(s, wv), "_len": F.length(s)})
    cnt = {aa: F.col("_p.counts")[i].cast("bigint") for i, aa in enumerate(C.AMINO_ACIDS)}
    tmp = tmp.withColumns({S.COUNT_PREFIX + aa: cnt[aa] for aa in S.count_refs()})
    nonempty = F.col("_len") > 0
    out = tmp.withColumns({
        "hydrophobicity": S.hydrophobicity_from_counts(cnt, F.col("_len")),
        "charge": F.when(nonempty, S.charge_from_counts(S.count_refs(), F.lit(ph), C.PKA_LEHNINGER)),
        "instability_index": _index(F.col("_p.pair_sum"), F.col("_len")),
        "isoelectric_point": F.when(nonempty, S.isoelectric_point_from_counts(S.count_refs())),
    })
    return S.drop_counts(out).drop("_p", "_len")
