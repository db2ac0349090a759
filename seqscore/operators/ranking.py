"""Ordering operators: global rank (W1), ordinals within groups (W4),
top-fraction split (W2/U2) and top-N (O2/O3).

A ``Window.orderBy`` without ``partitionBy`` moves every row into one
task, and ``Window.partitionBy(key)`` does the same for a hot key.  The
operators here instead cut the full sort key into P ranges (P = a
configured number), number rows inside each range, and add offsets from a
summary of at most 2P rows, so no task ever holds more than about N/P rows
whatever the key skew.

The bounds of the ranges are literals: a sample of the keys is read once,
and a row finds its range by binary search over them: over the first item of
the key as a double, which is compiled code, and only where that equals the
bound's over the whole key, which is interpreted.  A row's range then
depends on nothing but its key, so the summary and the rows agree in every
evaluation, also after a lost executor, and no ranged copy has to be
written.  (Spark's own range exchange draws its bounds anew for every
evaluation, from a sample that depends on the plan.)
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from seqscore.session import cut_lineage

_RANGE, _LEAD, _BUCKET = "_ss_range", "_ss_lead", "_ss_bucket"

# Keys sampled for each range: ranges then differ by about 1 / sqrt(100) in size.
SAMPLES_PER_RANGE = 100
_HASHES = 1 << 40

# Microseconds, so that bounds keep the order of the keys they were taken from.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
         "ignoreNullFields": "false"}


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _sort_key_names(order: list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


@dataclass(frozen=True)
class _SortKey:
    """One item of an order: what is sorted by, and how."""

    value: Column
    descending: bool
    nulls_last: bool

    @classmethod
    def of(cls, df: DataFrame, item: Column) -> "_SortKey":
        node = item._jc.node()
        if node.getClass().getSimpleName() != "SortOrder":
            return cls(item, False, False)
        value = Column(df.sparkSession._jvm.org.apache.spark.sql.Column(node.child()))
        return cls(value, "Descending" in node.sortDirection().toString(), "NullsLast" in node.nullOrdering().toString())

    def before(self, a: Column, b: Column) -> Column:
        x, y = (b, a) if self.descending else (a, b)
        nulls = (a.isNotNull() & b.isNull()) if self.nulls_last else (a.isNull() & b.isNotNull())
        return nulls | F.coalesce(x < y, F.lit(False))


class KeyRanges:
    """At most ``p`` ranges of the rows of ``df`` along ``order``, with literal bounds.

    The sample takes keys by their hash, so it is the same in any partitioning;
    the driver receives about 100 keys a range.  ``n_rows``: the number of rows
    where it is known."""

    def __init__(self, df: DataFrame, order: list[Column], p: int, n_rows: int | None = None):
        self._keys = [_SortKey.of(df, c) for c in order]
        named = [k.value.alias(f"k{i}") for i, k in enumerate(self._keys)]
        keys = df.select(*named)
        self._type = keys.schema
        share = SAMPLES_PER_RANGE * p / max(1, df.count() if n_rows is None else n_rows)
        if share < 1:
            keys = keys.filter(F.pmod(F.xxhash64(*keys.columns), F.lit(_HASHES)) < F.lit(int(share * _HASHES)))
        ordered = [F.col(f"k{i}").desc_nulls_last() if k.descending and k.nulls_last else
                   F.col(f"k{i}").desc_nulls_first() if k.descending else
                   F.col(f"k{i}").asc_nulls_last() if k.nulls_last else F.col(f"k{i}").asc_nulls_first()
                   for i, k in enumerate(self._keys)]
        # so few rows are put in order by one task, which spares a range exchange a reading of its own
        sample = [tuple(r) for r in keys.repartition(1).sortWithinPartitions(*ordered).select(
            F.to_json(F.struct(*keys.columns), _JSON), self._lead(F.col("k0"))).collect()] if p > 1 else []
        picked = dict(sample[len(sample) * j // p] for j in range(1, p)) if sample else {}
        self._bounds, self._leads = list(picked), list(picked.values())

    def _lead(self, first: Column) -> Column:
        """The first item of a key as a double that never falls along the order
        (unequal items may share one); NULL where it has none."""
        if not isinstance(self._type["k0"].dataType, NumericType):
            return F.lit(None).cast("double")
        lead = first.cast("double")
        return (-lead if self._keys[0].descending else lead) + F.lit(0.0)  # one zero

    @property
    def bounds(self) -> Column:
        """The lower bounds of all ranges but the first, as one literal."""
        ddl = f"array<{self._type.simpleString()}>"
        return F.from_json(F.lit("[" + ",".join(self._bounds) + "]"), ddl, _JSON)

    def _before(self, a: Column, b: Column) -> Column:
        out = F.lit(False)
        for i, k in reversed(list(enumerate(self._keys))):
            x, y = a[f"k{i}"], b[f"k{i}"]
            out = k.before(x, y) | (x.eqNullSafe(y) & out)
        return out

    def numbered(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of each row's range: how many bounds are not
        after its key.  A row whose first item differs from those of all bounds
        is placed by it alone; the others, and NULL and NaN, by the whole key."""
        known = [v for v in self._leads if v is not None]
        if not known or not all(map(math.isfinite, known)):
            return df.withColumn(_RANGE, self.number())
        steps = sorted(set(known))
        nulls = len(self._leads) - len(known) if self._leads[0] is None else 0
        upto = [nulls, *(nulls + bisect_right(known, v) for v in steps)]
        placed = Bucketizer(splits=[-math.inf, *steps, math.inf], inputCol=_LEAD, outputCol=_BUCKET,
                            handleInvalid="keep").transform(df.withColumn(_LEAD, self._lead(self._keys[0].value)))
        bucket, lead = F.col(_BUCKET).cast("int"), F.col(_LEAD)
        tied = F.coalesce(F.get(F.lit(steps), bucket - 1) == lead, F.lit(False))
        return placed.withColumn(_RANGE, F.coalesce(
            F.when(lead.isNull() | F.isnan(lead) | tied, self.number()).otherwise(F.get(F.lit(upto), bucket)),
            F.lit(0))).drop(_LEAD, _BUCKET)

    def groups(self, df: DataFrame, names: list[str]) -> DataFrame:
        """The first items of the bounds, each combination once, as columns ``names``."""
        items = F.transform(self.bounds, lambda b: F.struct(*(b[f"k{i}"].alias(n) for i, n in enumerate(names))))
        return df.sparkSession.range(1).select(F.explode(F.array_distinct(items)).alias("_b")).select("_b.*")

    def number(self) -> Column:
        """The number of a row's range, from 0, by search over the whole key."""
        n = len(self._bounds)
        if n == 0:
            return F.lit(0)
        steps = F.array(*[F.lit(1 << e) for e in reversed(range(n.bit_length()))])
        bounds = self.bounds
        start = F.struct(F.lit(0).alias("at"), F.struct(
            *[k.value.alias(f"k{i}") for i, k in enumerate(self._keys)]).alias("key"))

        def search(acc: Column, step: Column) -> Column:
            to = acc["at"] + step
            fits = (to <= F.lit(n)) & ~self._before(acc["key"], F.get(bounds, to - 1))
            return F.struct(F.when(fits, to).otherwise(acc["at"]).alias("at"), acc["key"].alias("key"))

        # never NULL, which spares the join on it a filter that searches once more
        return F.coalesce(F.aggregate(steps, start, search, lambda acc: acc["at"]), F.lit(0))


def global_rank(df: DataFrame, order: list[Column | str], name: str = "rank",
                num_partitions: int | None = None, pin_input: bool = True,
                keys_from: DataFrame | None = None, n_rows: int | None = None) -> DataFrame:
    """1..n over a total order (``order`` must end in a unique tie-breaker).

    Plan: keys sampled for the literal bounds -> range number by binary search ->
    one exchange on it -> numbers inside each range -> running offsets from the
    counts of the ranges (P rows), joined by broadcast.  Partitions of the
    result hold the ranks in order.

    ``pin_input`` checkpoints the input first, since its keys are read three times
    more and it must give the same rows each time (pass False for a pinned copy,
    a filter of one, or a scan).  ``keys_from``: the same rows where their keys
    are cheaper to read, for a rank upon a rank.  ``n_rows``: their number where
    it is known, which spares a reading.
    """
    keys = _sort_key_names(order)
    p = _partitions(df, num_partitions)
    src = cut_lineage(df) if pin_input else df
    like = src if keys_from is None else keys_from
    ranges = KeyRanges(like, keys, p, n_rows)
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.numbered(like).groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n"))
               .select(_RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    local = (ranges.numbered(src).repartitionById(p, F.col(_RANGE))
             .withColumn("_rn", F.row_number().over(Window.partitionBy(_RANGE).orderBy(*keys))))
    return (local.join(F.broadcast(offsets), _RANGE)
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop(_RANGE, "_rn", "_off"))


def ordinal_within(df: DataFrame, group: list[str], order: list[Column | str],
                   name: str = "ord", num_partitions: int | None = None, pin_input: bool = True) -> DataFrame:
    """1-based position of each row inside its group, ordered by ``order``
    (``row_number() OVER (PARTITION BY group ORDER BY order)``);
    (group, order) must be unique.

    One plan for every input: (group, order) is cut into ranges with literal
    bounds and rows are numbered inside their range.  A group that spans ranges
    holds one of the bounds, so at most 2P pairs of range and group need counts:
    their running sums are the offsets.  No group has to fit into one task.
    ``pin_input=False`` is for inputs that are cheap to read more than once and
    give the same rows each time, such as a scan."""
    p = _partitions(df, num_partitions)
    src = cut_lineage(df) if pin_input else df
    keys = [F.col(g) for g in group] + _sort_key_names(order)
    ranges = KeyRanges(src, keys, p)
    names = [f"_ss_g{i}" for i in range(len(group))]
    same = F.lit(True)
    for g, n in zip(group, names):
        same = same & F.col(g).eqNullSafe(F.col(n))
    at_bound = ranges.numbered(src.join(F.broadcast(ranges.groups(src, names)), same, "left_semi"))
    earlier = Window.partitionBy(*names).orderBy("_ss_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (at_bound
               .groupBy(F.col(_RANGE).alias("_ss_r"), *[F.col(g).alias(n) for g, n in zip(group, names)])
               .agg(F.count(F.lit(1)).alias("_n"))
               .select("_ss_r", *names, F.sum("_n").over(earlier).alias("_off")))
    # a task holds one range: the group in front makes the sort compare groups first
    local = ranges.numbered(src).repartitionById(p, F.col(_RANGE)).withColumn("_rn", F.row_number().over(
        Window.partitionBy(*group, _RANGE).orderBy(*_sort_key_names(order))))
    return (local.join(F.broadcast(offsets), (F.col(_RANGE) == F.col("_ss_r")) & same, "left")
            .withColumn(name, (F.col("_rn") + F.coalesce("_off", F.lit(0))).cast("bigint"))
            .drop(_RANGE, "_rn", "_ss_r", *names, "_off"))


def winner_count(n_rows: int, fraction: float) -> int:
    """``max(1, int(n * fraction))`` (double product, floor; as in SQL)."""
    return max(1, int(math.floor(n_rows * float(fraction))))


def one_row(df: DataFrame):
    """The single row of a one-row aggregate or lookup (None when empty).

    Scalars are evaluated once, as their own small job, and enter the main
    plan as literals: a scalar subquery would copy its whole sub-plan into
    every expression that references it."""
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("expected at most one row")
    return rows[0] if rows else None


def top_fraction_split(ranked: DataFrame, fraction: float, rank_col: str = "rank",
                       flag: str = "is_winner") -> DataFrame:
    """Flag the first ``max(1, floor(n*fraction))`` ranks as winners.

    ``n`` is one global count (ranks are 1..n, so it is the largest rank);
    the flag is then a plain projection and winners and losers partition
    the input.
    """
    n = ranked.count()
    return ranked.withColumn(flag, F.col(rank_col) <= F.lit(winner_count(n, fraction)))


def split(ranked: DataFrame, flag: str = "is_winner") -> tuple[DataFrame, DataFrame]:
    """Complementary winners / losers frames."""
    return ranked.filter(F.col(flag)), ranked.filter(~F.col(flag))


def top_n(df: DataFrame, order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows in order; planned as TakeOrderedAndProject
    (a per-partition heap, then one merge of P*n rows)."""
    return df.orderBy(*_sort_key_names(order)).limit(int(n))
