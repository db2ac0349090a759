"""Sequence expressions.

All are native Column expressions over the whole sequence string; no
Python runs per row.  Residue counts use ``length - length(replace)``,
one linear scan per residue kind, which codegen keeps tight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqscore import constants as C


def normalize_sequence(col: Column) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too), upper-case.
    ``trim`` alone removes only spaces."""
    return F.upper(F.regexp_replace(col, r"^\s+|\s+$", ""))


def parse_id(col: Column) -> Column:
    """``seq_<n>`` -> n (BIGINT); anything else -> NULL (lenient form)."""
    return F.regexp_extract(col, r"^seq_(\d+)$", 1).try_cast("bigint")


def parse_id_strict(col: Column) -> Column:
    """Like ``parse_id`` but fails the task on a malformed id."""
    v = parse_id(col)
    return F.when(F.assert_true(v.isNotNull() | col.isNull(),
                                F.concat(F.lit("bad id: "), col)).isNull(), v)


def format_id(idx: Column) -> Column:
    return F.concat(F.lit("seq_"), idx.cast("string"))


def count_char(col: Column, ch: str) -> Column:
    """Occurrences of one literal character."""
    return (F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))).cast("bigint")


def cys_count(col: Column) -> Column:
    """Upper-case ``C`` in the sequence as given."""
    return count_char(col, "C")


def clean_generated(col: Column) -> Column:
    """Drop newlines, then one leading ``M`` when more than one residue."""
    s = F.replace(col, F.lit("\n"), F.lit(""))
    return F.when(s.startswith("M") & (F.length(s) > 1), F.substring(s, 2, 1 << 30)).otherwise(s)


def preview(col: Column, n: int = 25) -> Column:
    return F.substring(col, 1, n)


def fasta_record(seq: Column, header: str = C.FASTA_HEADER) -> Column:
    return F.concat(F.lit(header + "\n"), seq, F.lit("\n"))


# ---------------------------------------------------------------------------
# Descriptors
# ---------------------------------------------------------------------------

def hydrophobicity_from_counts(counts: dict[str, Column], n: Column,
                               scale: dict = C.KYTE_DOOLITTLE) -> Column:
    """Mean scale value per residue from residue counts and the length;
    residues outside the scale weigh 0.  Empty sequences -> NULL."""
    total = None
    for aa, v in scale.items():
        term = counts[aa] * F.lit(float(v))
        total = term if total is None else total + term
    return F.when(n > 0, total / n)


def hydrophobicity(col: Column, scale: dict = C.KYTE_DOOLITTLE) -> Column:
    """Mean scale value per residue; residues outside the scale weigh 0.
    Empty sequences -> NULL."""
    return hydrophobicity_from_counts({aa: count_char(col, aa) for aa in scale}, F.length(col), scale)


def _pos(ph: Column, pka: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), ph - F.lit(pka)))


def _neg(ph: Column, pka: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), F.lit(pka) - ph))


def charge_from_counts(counts: dict[str, Column], ph: Column, pka: dict) -> Column:
    """Henderson-Hasselbalch net charge from residue counts."""
    z = _pos(ph, pka["Nterm"]) - _neg(ph, pka["Cterm"])
    for aa in C.POSITIVE_SIDE_CHAINS:
        z = z + counts[aa] * _pos(ph, pka[aa])
    for aa in C.NEGATIVE_SIDE_CHAINS:
        z = z - counts[aa] * _neg(ph, pka[aa])
    return z


def ionisable_counts(col: Column) -> dict[str, Column]:
    return {aa: count_char(col, aa) for aa in C.POSITIVE_SIDE_CHAINS + C.NEGATIVE_SIDE_CHAINS}


def charge(col: Column, ph: float = 7.4, pka: dict = C.PKA_LEHNINGER) -> Column:
    """Net charge at ``ph``.  Empty sequences -> NULL."""
    return F.when(F.length(col) > 0, charge_from_counts(ionisable_counts(col), F.lit(ph), pka))


def isoelectric_point_from_counts(cts: dict[str, Column], pka: dict = C.PKA_EMBOSS,
                                  steps: int = 40, lo: float = 0.0, hi: float = 14.0) -> Column:
    """pH where the net charge is zero: fixed-step bisection on [lo, hi]
    run as an ``aggregate`` over ``sequence(1, steps)``, so it stays a
    native expression.  Charge falls monotonically with pH.  ``cts`` should
    be plain column references (materialise the counts first; see
    ``with_ionisable_counts``) so the strings are scanned once, not per step."""

    def step(acc, _i):
        mid = (acc["lo"] + acc["hi"]) / 2.0
        pos = charge_from_counts(cts, mid, pka) > 0
        return F.struct(F.when(pos, mid).otherwise(acc["lo"]).alias("lo"),
                        F.when(pos, acc["hi"]).otherwise(mid).alias("hi"))

    init = F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    res = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step)
    return (res["lo"] + res["hi"]) / 2.0


COUNT_PREFIX = "_n_"


def with_ionisable_counts(df, seq_col: str = "sequence"):
    """Add one count column per ionisable residue (scanned once per row)."""
    return df.withColumns({COUNT_PREFIX + aa: c for aa, c in ionisable_counts(F.col(seq_col)).items()})


def count_refs() -> dict[str, Column]:
    return {aa: F.col(COUNT_PREFIX + aa) for aa in C.POSITIVE_SIDE_CHAINS + C.NEGATIVE_SIDE_CHAINS}


def drop_counts(df):
    return df.drop(*[COUNT_PREFIX + aa for aa in C.POSITIVE_SIDE_CHAINS + C.NEGATIVE_SIDE_CHAINS])


def isoelectric_point(df, seq_col: str = "sequence", name: str = "isoelectric_point",
                      pka: dict = C.PKA_EMBOSS):
    """DataFrame form: adds ``name`` (NULL for empty sequences)."""
    tmp = with_ionisable_counts(df, seq_col)
    tmp = tmp.withColumn(name, F.when(F.length(F.col(seq_col)) > 0,
                                      isoelectric_point_from_counts(count_refs(), pka)))
    return drop_counts(tmp)


def dipeptides(col: Column) -> Column:
    """All overlapping dipeptides as an array: pairs at odd offsets, then
    pairs at even offsets (two native regex passes, no per-position rows
    carrying the whole string)."""
    return F.concat(F.regexp_extract_all(col, F.lit("(..)"), 1),
                    F.regexp_extract_all(F.substring(col, 2, 1 << 30), F.lit("(..)"), 1))
