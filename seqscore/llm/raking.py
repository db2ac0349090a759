"""Mixing sources to target weights by iterative proportional fitting (op 6).

Tokens are added up by cell (source, language, topic); the cells' weights are
raked to the target marginals of each dimension in turn until all hold, and
documents are sampled with probabilities in proportion to their cell's weight.
DataFrame operations only.

Documents are read twice (adding up, sampling) and never shuffled; the raking
itself works on the table of cells, whose marginals are partial aggregates: no
task gathers the cells of a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_name

# A table of cells of at most this many rows (well below 100 bytes each beside
# the names) is broadcast for sampling; a larger one is joined by its keys.
BROADCAST_CELLS = 50_000
ROUNDS_PER_CHECK = 4
DIMENSIONS = ("source", "lang", "topic")


def words(text: Column) -> Column:
    """Number of words of a text, the token measure of the mix; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic by plain marks in the text, the first that holds: rights
    notices, personal contact, links, program-like text, short, long, prose."""
    has = lambda *marks: F.greatest(*(F.contains(text, F.lit(m)) for m in (*marks, marks[0])))
    return (F.when(text.isNull() | (F.trim(text) == ""), "empty")
            .when(has("rights reserved", "Licensed under", "Copyright", "SPDX-License"), "rights")
            .when(has("http://", "https://", "www."), "links")
            .when(has("@"), "contact")
            .when(has("{", "};", "def ", "#include"), "code")
            .when(F.length(text) < 400, "short")
            .when(F.length(text) >= 4000, "long")
            .otherwise("prose"))


def _key(col: Column) -> Column:
    """A dimension's value as text that tells null from any text."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def tempered_targets(cells: DataFrame, dim: str, exponent: float) -> DataFrame:
    """(dim, share): the dimension's token shares to the power ``exponent``,
    normalised; below 1, it lifts what is rare."""
    t = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).filter("t > 0")
    s = t.select(dim, F.pow("t", F.lit(exponent)).alias("s"))
    total = s.agg(F.sum("s").alias("total"))  # one row
    return s.join(F.broadcast(total)).select(dim, (F.col("s") / F.col("total")).alias("share"))


def given_targets(cells: DataFrame, dim: str, shares: dict) -> DataFrame:
    """(dim, share) from a dictionary value -> share (None: null); values without
    tokens are left out, values without a share get none, the rest add up to 1."""
    spark = cells.sparkSession
    rows = [("null" if k is None else f"={k}", float(v)) for k, v in shares.items()]
    t = (cells.groupBy(dim).agg(F.sum("tokens").alias("t")).filter("t > 0")
         .join(F.broadcast(spark.createDataFrame(rows, f"{dim} string, s double")), dim))
    total = t.agg(F.sum("s").alias("total"))
    return t.join(F.broadcast(total)).select(dim, (F.col("s") / F.col("total")).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-4,
         max_rounds: int = 60) -> DataFrame:
    """``cells`` (dimensions, tokens) with a column weight, so that the weighted
    tokens meet every target share of every dimension.

    Raking goes on until no marginal misses its target by more than
    ``tolerance`` of the total, or ``max_rounds``: targets that contradict each
    other on sparse cells have no solution, and the last round is returned."""
    dims = list(targets)
    cells = cells.filter("tokens > 0")
    for d in dims:
        cells = cells.join(targets[d].withColumnRenamed("share", f"share_{d}"), d)
    cells = cut_lineage(cells.withColumn("weight", F.lit(1.0)))
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.select(*dims, "tokens", "weight")
    for _ in range(0, max_rounds, ROUNDS_PER_CHECK):
        for _ in range(ROUNDS_PER_CHECK):
            for d in dims:
                # a marginal is aggregated in part before it is shuffled, and joined back
                have = cells.groupBy(d).agg(F.sum(F.col("weight") * F.col("tokens")).alias("have"))
                cells = cells.join(have, d).withColumn("weight", F.when(
                    F.col("have") > 0, F.col("weight") * F.col(f"share_{d}") * F.lit(float(total)) / F.col("have")
                ).otherwise(0.0)).drop("have")
            # each step reads the cells twice: pinned every round, the plan stays small
            cells = cut_lineage(cells)
        # the last dimension holds exactly after its step; the others show the error
        missed = 0.0
        for d in dims[:-1]:
            e = (cells.groupBy(d).agg(F.sum(F.col("weight") * F.col("tokens")).alias("have"),
                                      F.first(f"share_{d}").alias("share"))
                 .agg(F.max(F.abs(F.col("have") / total - F.col("share")))).first()[0])
            missed = max(missed, e or 0.0)
        if missed <= tolerance:
            break
    return cells.select(*dims, "tokens", "weight")


def sampling_rate(cells: DataFrame, fraction: float) -> float:
    """The factor on weights for which the expected sample, its probabilities
    cut at 1, holds ``fraction`` of all weighted-in tokens."""
    total, mass = cells.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("weight"))).first()
    if not total or not mass:
        return 0.0
    wanted, rate = fraction * total, fraction * total / mass
    for _ in range(100):  # each step can only cut more cells at 1
        full = F.col("weight") * F.lit(rate) >= 1
        cut, rest = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)),
                              F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("weight")))).first()
        new = (wanted - cut) / rest if rest else rate
        if new <= rate * (1 + 1e-9):
            break
        rate = new
    return rate


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        lang_col: str = "lang", topic_of: Column | None = None, tokens_of: Column | None = None,
        targets: dict[str, dict] | None = None, exponent: float = 0.7, fraction: float = 0.6,
        seed: int = 42, prefix: str = "mix_") -> DataFrame:
    """``docs``, all rows and columns, with the columns ``prefix`` + source, lang,
    topic (as text that starts with "=", or "null"), tokens, weight,
    probability and sampled.

    ``targets`` gives shares by dimension; a dimension without them gets its
    own token shares to the power ``exponent``.  ``fraction`` of the tokens are
    sampled in expectation.  The draw is a hash of the id (of the text where
    the id is null), the same in every run.  Documents without a token, or
    whose value has no target share, get weight 0 and are not sampled."""
    p = prefix
    made = [f"{p}{x}" for x in (*DIMENSIONS, "tokens", "weight", "probability", "sampled")]
    clash = {c.lower() for c in docs.columns} & {c.lower() for c in made}
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already: choose another prefix")
    on_dim = {d: free_name(docs.columns, f"__{d}") for d in DIMENSIONS}
    text = F.col(text_col)
    tagged = docs.withColumns({
        f"{p}source": _key(F.col(source_col)), f"{p}lang": _key(F.col(lang_col)),
        f"{p}topic": _key(topic(text) if topic_of is None else topic_of),
        f"{p}tokens": words(text) if tokens_of is None else tokens_of.cast("long")})
    cells = cut_lineage(
        tagged.select(*(F.col(f"{p}{d}").alias(d) for d in DIMENSIONS), F.col(f"{p}tokens").alias("tokens"))
        .groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")))
    shares = {d: given_targets(cells, d, targets[d]) if d in (targets or {})
              else tempered_targets(cells, d, exponent) for d in DIMENSIONS}
    raked = cut_lineage(rake(cells, shares))
    rate = sampling_rate(raked, fraction)
    small = raked.count() <= BROADCAST_CELLS
    weights = raked.select(*(F.col(d).alias(on_dim[d]) for d in DIMENSIONS), F.col("weight").alias(f"{p}weight"))
    on = [F.col(f"{p}{d}") == F.col(on_dim[d]) for d in DIMENSIONS]
    found = tagged.join(F.broadcast(weights) if small else weights, on, "left").drop(
        *on_dim.values())
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text))
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    chance = F.when(F.col(f"{p}tokens") > 0, F.least(
        F.lit(1.0), F.coalesce(F.col(f"{p}weight"), F.lit(0.0)) * F.lit(rate))).otherwise(0.0)
    return (found.withColumn(f"{p}weight", F.coalesce(f"{p}weight", F.lit(0.0)))
            .withColumn(f"{p}probability", chance)
            .withColumn(f"{p}sampled", (draw < F.col(f"{p}probability")).cast("int")))
