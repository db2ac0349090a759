"""File sinks (K1-K4 and the PDB writer used by round trips).

Every writer is a plain DataFrame write: rows are rendered to text with
native string functions, partitioned by Spark, and written in parallel.
Nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from seqscore import constants as C


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A16 without a second pass: the returned frame carries a row-count
    observation that is filled in by whatever action writes it
    (``obs.get["rows"]`` after the write)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> str:
    """K1: header row, fixed column order, no index."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_jsonl(df: DataFrame, path: str) -> str:
    """K2: one JSON object per line (an empty frame writes no records)."""
    df.write.mode("overwrite").json(path)
    return path


def write_json_summary(df: DataFrame, path: str) -> str:
    """K3: a one-row frame as a single JSON object, NULL fields kept."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def fasta_text(df: DataFrame, id_col: str = "id", seq_col: str = "sequence",
               clean: bool = True) -> DataFrame:
    """``>{id} A|protein`` then the sequence, one record per row.  The
    id is kept in the header so records can share a file (the per-file
    naming of the source layout does not scale to many small files)."""
    seq = F.upper(F.regexp_replace(F.col(seq_col), r"^\s+|\s+$", "")) if clean else F.col(seq_col)
    header = F.concat(F.lit(">"), F.col(id_col), F.lit(" " + C.FASTA_HEADER[1:]))
    return df.select(F.concat(header, F.lit("\n"), seq).alias("value"))


def write_fasta(df: DataFrame, path: str, id_col: str = "id", seq_col: str = "sequence") -> str:
    """K4: overwrite (stale records never survive), many records per file."""
    fasta_text(df, id_col, seq_col).write.mode("overwrite").text(path)
    return path


def _field(text: Column, width: int, what: str, left: bool = False) -> Column:
    """The text padded to its fixed field; a text that doesn't fit fails the
    job with its value instead of being cut."""
    padded = F.rpad(text, width, " ") if left else F.lpad(text, width, " ")
    wide = F.raise_error(F.concat(F.lit(f"{what} doesn't fit its {width} columns: "), text))
    return F.when(F.length(text) <= width, padded).when(text.isNull(), F.lit(" " * width)).otherwise(wide)


def _fixed(v: Column, width: int, digits: int, what: str) -> Column:
    """``%{width}.{digits}f`` of the decimal value (half to even on the decimal,
    so the text does not depend on binary rounding)."""
    dec = F.bround(v.cast("decimal(20,7)"), digits).cast(f"decimal(20,{digits})")
    return _field(dec.cast("string"), width, what)


def _number(n: Column, width: int) -> Column:
    """A serial or residue number in ``width`` columns: decimal as far as it
    fits, then hybrid-36 (A000..., as PDB tools write large structures), then
    blank; readers go by the order of records."""
    most = 10 ** width
    first = 10 * 36 ** (width - 1)
    letters = F.conv((n - most + first).cast("string"), 10, 36)
    return (F.when(n < most, F.lpad(n.cast("string"), width, " "))
            .when(n < most + 26 * 36 ** (width - 1), letters).otherwise(F.lit(" " * width)))


def pdb_atom_line(pos_col: str = "ord", all_atoms: bool = False) -> Column:
    """One ``ATOM`` record (PDB v3.3 fixed columns): a CA of chain A whose
    residue number is its position, or with ``all_atoms`` the atom that the
    columns atom, chain, resseq and icode name."""
    n = F.col(pos_col)
    if all_atoms:
        # names of up to three characters start in the second of their four columns
        name = F.when(F.length("atom") < 4, F.concat(F.lit(" "), F.col("atom"))).otherwise(F.col("atom"))
        who = [F.lit(" "), _field(name, 4, "atom name", left=True), F.lit(" "),
               _field(F.col("resname"), 3, "residue name", left=True), F.lit(" "), _field(F.col("chain"), 1, "chain"),
               _number(F.col("resseq").cast("bigint"), 4), _field(F.col("icode"), 1, "insertion code"), F.lit("   ")]
    else:
        who = [F.lit("  CA  "), _field(F.col("resname"), 3, "residue name", left=True), F.lit(" A"), _number(n, 4),
               F.lit("    ")]
    return F.concat(
        F.lit("ATOM  "), _number(n, 5), *who,
        _fixed(F.col("x"), 8, 3, "x"), _fixed(F.col("y"), 8, 3, "y"), _fixed(F.col("z"), 8, 3, "z"),
        F.lit("  1.00"), _fixed(F.col("plddt"), 6, 2, "plddt"), F.lit("           C"))


MAX_LINES_PER_FILE = 1_000_000   # ~80 MB of PDB text per file


def write_pdb(atoms: DataFrame, path: str, num_files: int, id_col: str = "id",
              pos_col: str = "ord", partition_col: str | None = None,
              max_lines_per_file: int = MAX_LINES_PER_FILE,
              order_col: str | None = None, all_atoms: bool = False, mode: str = "overwrite") -> str:
    """Multi-structure PDB text files: per structure a ``HEADER`` line with
    the id, its ``ATOM`` lines in position order, and ``END``.

    One hash exchange on the structure id, and a sort within partitions that
    makes every structure one contiguous block of one file.  Positions and
    the first and last atom come from running windows over that order (row
    number, look-ahead by one), which hold no structure in memory; header and
    ``END`` ride on the first and last atom's text row.  The file count is at
    least ``num_files`` and grows with the atom count so a file stays near
    ``max_lines_per_file`` lines.  ``partition_col`` optionally adds a
    directory level.  With ``order_col`` the positions are numbered here;
    otherwise ``pos_col`` holds them.  A coordinate, pLDDT or residue name
    that its field can't hold fails the job.  ``all_atoms`` writes named atoms
    (see ``pdb_atom_line``); ``mode`` may be ``append``."""
    n_atoms = atoms.count()
    num_files = max(int(num_files), -(-n_atoms // int(max_lines_per_file)))
    src = F.col(order_col) if order_col else F.col(pos_col).cast("bigint")
    named = ["atom", "chain", "resseq", "icode"] if all_atoms else []
    keep = [F.col(id_col).alias("id"), src.alias("_src"), "resname", *named, "x", "y", "z",
            "plddt"] + ([partition_col] if partition_col else [])
    a = atoms.select(*keep).repartition(int(num_files), "id")
    w = Window.partitionBy("id").orderBy("_src")
    a = a.withColumns({"_nth": F.row_number().over(w).cast("bigint"),
                       "_end": F.lead(F.lit(1)).over(w).isNull()})
    a = a.withColumn("_pos", F.col("_nth") if order_col else F.col("_src"))
    text = F.concat(
        F.when(F.col("_nth") == 1, F.concat(F.lit("HEADER    "), F.col("id"), F.lit("\n"))).otherwise(F.lit("")),
        pdb_atom_line("_pos", all_atoms),
        F.when(F.col("_end"), F.lit("\nEND")).otherwise(F.lit("")))
    # With a directory level the writer needs rows ordered by it; leading
    # the sort with it keeps the block order (no second, unstable sort).
    order = ([partition_col] if partition_col else []) + ["id", "_pos"]
    cols = [text.alias("value")] + ([partition_col] if partition_col else [])
    out = a.sortWithinPartitions(*order).select(*cols).write.mode(mode)
    if partition_col:
        out = out.partitionBy(partition_col)
    out.text(path)
    return path
