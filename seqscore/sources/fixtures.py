"""Views that map the given tables onto the engine's data model.

* ``ca_atoms`` (lineitem): one CA atom per line item, structure key
  ``seq_idx = l_orderkey``; file order is the natural line key
  ``(l_linenumber, l_partkey, l_suppkey, l_extendedprice)``.
* ``peptides`` (documents): the whole text reduced to residue letters.
* ``relaxed_atoms``: ``ca_atoms`` displaced by a position-dependent shift.
* ``energies`` (orders): per-structure energies before/after relaxation,
  missing (a failed run) for pending orders and for structures without an order.

The SQL text of the same views lives in ``seqscore.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqscore import constants as C
from seqscore.operators.ranking import ordinal_within
from seqscore.session import cut_lineage
from seqscore.sources.tables import read_table

# FIXED VALUES: residue names indexed by ``l_partkey % 21`` (the twenty
# standard residues in conventional order, then an unknown residue).
FIXTURE_RESIDUES = C.THREE_LETTER + ("UNK",)

ATOM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def ca_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq_idx, ord_key (struct, file order), resname, x, y, z, plddt."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax"])
    names = F.array(*[F.lit(r) for r in FIXTURE_RESIDUES])
    return li.select(
        F.col("l_orderkey").alias("seq_idx"),
        F.struct(*[F.col(c) for c in ATOM_ORDER]).alias("ord_key"),
        F.element_at(names, (F.col("l_partkey") % len(FIXTURE_RESIDUES)).cast("int") + 1).alias("resname"),
        (F.col("l_quantity") / 10.0).alias("x"),
        (F.col("l_extendedprice") / 20000.0).alias("y"),
        (F.col("l_discount") * 20.0).alias("z"),
        (F.lit(1.0) - F.col("l_tax")).alias("plddt"),
    )


def ca_atoms_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ca_atoms`` plus ``ord`` (1-based file position in its structure),
    computed without a per-structure window (see ``ordinal_within``)."""
    a = ca_atoms(spark, sf_dir)
    return ordinal_within(a, ["seq_idx"], ["ord_key"], "ord", pin_input=False)


def ca_atoms_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ca_atoms_ordered`` without ``ord_key``, dealt by structure and position:
    both sides of an alignment read this one exchange, and neither numbers the
    atoms again."""
    return ca_atoms_ordered(spark, sf_dir).drop("ord_key").repartition("seq_idx", "ord")


# FIXED VALUES: the atoms of a residue's backbone in their usual order.
BACKBONE = ("N", "CA", "C", "O", "CB")


def all_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ca_atoms_ordered`` read as the backbones of two chains: atoms of odd
    position belong to chain A, the others to B; five make a residue.  The
    positions are pinned: files of both sides are counted and written from
    them, and each of these would number the atoms anew."""
    nth = F.floor((F.col("ord") - 1) / 2)
    return cut_lineage(ca_atoms_ordered(spark, sf_dir).drop("ord_key")).select(
        "seq_idx", structure_id().alias("id"), "ord", "resname", F.when(F.col("ord") % 2 == 1, "A").otherwise("B").alias("chain"),
        (F.floor(nth / 5) + 1).cast("bigint").alias("resseq"), F.lit("").alias("icode"),
        F.element_at(F.array(*map(F.lit, BACKBONE)), (nth % 5 + 1).cast("int")).alias("atom"),
        "x", "y", "z", "plddt")


def relaxed_all_atoms(atoms: DataFrame) -> DataFrame:
    """``all_atoms`` after a relaxation that returns them in reverse order;
    every seventh structure lost its first atom, every eleventh got one more."""
    lost = (F.col("seq_idx") % 7 == 3) & (F.col("ord") == 1)
    extra = atoms.filter((F.col("seq_idx") % 11 == 5) & (F.col("ord") == 1)).withColumns(
        {"atom": F.lit("OXT"), "ord": F.lit(0).cast("bigint")})
    return atoms.filter(~lost).unionByName(extra).withColumns({
        "x": F.col("x") + (F.col("ord") % 3) * F.lit(0.125), "y": F.col("y") - F.lit(0.25), "ord": -F.col("ord")})


def relaxed_atoms(atoms_ordered: DataFrame) -> DataFrame:
    """The same atoms after a deterministic relaxation shift."""
    return atoms_ordered.select(
        "seq_idx", "ord", "resname",
        (F.col("x") + (F.col("ord") % 3) * F.lit(0.125)).alias("x"),
        (F.col("y") - F.lit(0.25)).alias("y"),
        F.col("z").alias("z"))


def structure_id(seq_idx: str = "seq_idx"):
    return F.concat(F.lit("seq_"), F.col(seq_idx).cast("string"))


def peptides(spark: SparkSession, sf_dir: str, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """seq_idx, id, sequence: every letter of the document, upper-cased
    ASCII, keeping the twenty residue codes (the whole text, no prefix);
    further columns of the documents on demand."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", *passthrough])
    letters = F.upper(F.regexp_replace(F.col("text"), "[^A-Za-z]", ""))
    aa = F.regexp_replace(letters, f"[^{C.AMINO_ACIDS}]", "")
    return docs.select(F.col("doc_id").alias("seq_idx"), structure_id("doc_id").alias("id"),
                       aa.alias("sequence"), *passthrough)


def synthetic_weights(spark: SparkSession) -> DataFrame:
    """(dipeptide, weight): a made-up table by a rule, standing in for the
    published one that a user supplies: for the residues' places i and j in
    conventional order, ((7 i + 13 j) mod 29 - 14) / 2."""
    aa = C.AMINO_ACIDS
    return spark.createDataFrame(
        [(a + b, ((7 * i + 13 * j) % 29 - 14) / 2) for i, a in enumerate(aa) for j, b in enumerate(aa)],
        "dipeptide string, weight double")


def energies(spark: SparkSession, sf_dir: str, scores: DataFrame) -> DataFrame:
    """Energies per scored structure: ``e_initial = o_custkey/4``,
    ``e_final = -floor(o_totalprice)/32``; both null (failed) when the order is
    pending ('P') or missing.  Both divisors are powers of two, so values on
    a 2-dp rounding tie occur and are exact in binary."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice",
                                                  "o_orderstatus"])
    ok = F.col("o_orderstatus") != F.lit("P")
    j = scores.join(orders, scores["seq_idx"] == orders["o_orderkey"], "left")
    return j.select(
        scores["*"],
        F.when(ok, F.col("o_custkey") / 4.0).alias("e_initial"),
        F.when(ok, -F.floor("o_totalprice") / 32.0).alias("e_final"))
