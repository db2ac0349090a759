"""Embedding near-duplicates by an exact metric range join (op 9).

Vectors at cosine c or more are unit vectors at distance r = sqrt(2 - 2c) or
less.  Pivots partition the vectors: each lives in the cell of its nearest
pivot.  If x lives with pivot p and has a partner in the cell of pivot q, then

* the triangle inequality gives d(x, q) <= d(x, p) + 2r,
* and d(x, q) <= r + the largest distance of that cell's vectors from q,
* and x lies within r of the half-space nearer to q than to p, so
  d(x, q)^2 - d(x, p)^2 <= 2 r d(p, q).

A copy of x visits the cells for which all three hold, of two cells only the
one with the smaller number, so that each pair meets once; cells then join
independently.  A cell is cut into tiles of at most about two blocks of
vectors, so no cell and no group of near copies, however large, lands in one
task.  A tile returns a number of links for each of its vectors and a
spanning forest, never its pairs.

Equal vectors are one before the join, so copies cost no comparisons.  Where
vectors have no structure at all (uniform on a sphere in many dimensions) the
conditions above exclude little and the work is that of all pairs of tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage
from .components import connected_components

# Pivots are broadcast: this many vectors at most, whatever the input.  Cells
# grow beyond that, and their tiles with them in number, not in size.
MAX_PIVOTS = 2048
BLOCK = 2048
SLAB = 256
# Distances decide only where copies go and get this much slack; the cosine in
# double precision decides a link.
SLACK = 1e-6


def _units(raw: pd.Series, dim: int, kind: str) -> np.ndarray:
    m = np.frombuffer(b"".join(raw), kind).reshape(-1, dim).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


class _Pivots:
    """Pivots of each dimension, numbered through, with what prunes visits."""

    def __init__(self, by_dim: dict[int, np.ndarray]):
        self.by_dim, self.first, at = by_dim, {}, 0
        for d, m in sorted(by_dim.items()):
            self.first[d] = at
            at += len(m)
        self.between = {d: np.sqrt(np.maximum(0, 2 - 2 * m @ m.T)) for d, m in by_dim.items()}

    def distances(self, unit: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * unit @ self.by_dim[unit.shape[1]].T))


def _dims(f: pd.DataFrame):
    for dim, part in f.groupby("dim", sort=True):
        yield int(dim), part


class _Tile:
    """Vectors of one tile as they arrive: left ones first, then right ones."""

    def __init__(self, dim: int, kind: str, same: bool, cosine: float):
        self.dim, self.kind, self.same, self.cosine = dim, kind, same, cosine
        self.nodes: list[int] = []
        self.links: list[np.ndarray] = []
        self.parent: list[int] = []
        self.left = np.zeros((0, dim))
        self.copies = np.zeros(0, np.int64)
        self.margin = 4e-7 * dim

    def _find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def _join(self, i: int, others: np.ndarray) -> None:
        roots = {self._find(int(x)) for x in np.unique(self.label[others])} | {self._find(i)}
        low = min(roots)
        for x in roots:
            self.parent[x] = low
        self.label[others] = low

    def add_left(self, f: pd.DataFrame) -> None:
        self.left = np.concatenate([self.left, _units(f["raw"], self.dim, self.kind)])
        self.copies = np.concatenate([self.copies, f["copies"].to_numpy(np.int64)])
        self.nodes += f["node"].tolist()

    def start(self) -> None:
        n = len(self.nodes)
        self.parent, self.label = list(range(n)), np.arange(n)
        self.count = np.zeros(n, np.int64)
        self.left32 = self.left.astype(np.float32)
        if self.same:
            self._compare(self.left, self.copies, 0)

    def add_right(self, f: pd.DataFrame) -> None:
        at, k = len(self.nodes), len(f)
        self.nodes += f["node"].tolist()
        self.parent += range(at, at + k)
        self.label = np.concatenate([self.label, np.arange(at, at + k)])
        self.count = np.concatenate([self.count, np.zeros(k, np.int64)])
        self._compare(_units(f["raw"], self.dim, self.kind), f["copies"].to_numpy(np.int64), at)

    def _compare(self, right: np.ndarray, copies: np.ndarray, at: int) -> None:
        """Links between the left vectors and ``right``, numbered from ``at``."""
        right32 = right.astype(np.float32)
        for lo in range(0, len(self.left), SLAB):
            near = self.left32[lo:lo + SLAB] @ right32.T
            link = near >= self.cosine + self.margin
            # single precision can't tell these: take the cosine in double
            i, j = np.nonzero((near >= self.cosine - self.margin) & ~link)
            for s in range(0, len(i), 1 << 18):
                a, b = i[s:s + (1 << 18)], j[s:s + (1 << 18)]
                link[a, b] = np.einsum("ij,ij->i", self.left[lo + a], right[b]) >= self.cosine
            if self.same:
                d = np.arange(len(near))
                link[d, lo + d] = False
            rows = np.flatnonzero(link.any(axis=1))
            if not len(rows):
                continue
            self.count[lo:lo + len(link)] += link @ copies
            if not self.same:
                self.count[at:at + len(right)] += self.copies[lo:lo + len(link)] @ link
            for r in rows.tolist():
                self._join(lo + r, at + np.flatnonzero(link[r]))

    def result(self) -> pd.DataFrame:
        roots = [self._find(x) for x in range(len(self.nodes))]
        nodes = np.asarray(self.nodes, np.int64)
        hit = np.flatnonzero(self.count)
        return pd.DataFrame({"node": nodes[hit], "n": self.count[hit],
                             "root": nodes[np.asarray(roots, np.int64)[hit]]})


TILE = ["dim", "cell", "block", "other", "chunk"]


def _join_tiles(tiles: DataFrame, cosine: float, kind: str) -> DataFrame:
    """(node, n, root) for the vectors of each tile that have a link there."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, tile, began = None, None, False
        for f in frames:
            key = f[TILE].to_numpy()
            cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)
                                  | (f["side"].to_numpy()[1:] != f["side"].to_numpy()[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(f)], strict=True):
                part, k = f.iloc[a:b], tuple(key[a])
                if k != now:
                    if tile is not None:
                        if not began:
                            tile.start()
                        yield tile.result()
                    dim, _, block, other, chunk = k
                    tile, now, began = _Tile(int(dim), kind, not other and block == chunk,
                                             cosine), k, False
                if part["side"].iloc[0] == 0:
                    tile.add_left(part)
                else:
                    if not began:
                        tile.start()
                        began = True
                    tile.add_right(part)
        if tile is not None:
            if not began:
                tile.start()
            yield tile.result()

    n = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (tiles.repartition(n, *TILE).sortWithinPartitions(*TILE, "side")
            .mapInPandas(run, "node long, n long, root long"))


def range_join(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
               min_cosine: float = 0.95, block: int = BLOCK,
               max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    n_links counts the other rows with a cosine of ``min_cosine`` or more,
    equal vectors among them; component_id is the smallest id reachable over
    links, the row's own included; kept says that it is the row's own.  A
    vector that is null, empty, zero or holds a null or non-finite component
    links with nothing, and vectors of different lengths don't link."""
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must lie in (0, 1]")
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    v = F.col(vec_col).cast("array<float>" if single else "array<double>")
    usable = (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
              & F.exists(v, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable, v).alias("v"))
    radius = math.sqrt(max(0.0, 2 - 2 * min_cosine))

    @F.pandas_udf(T.BinaryType())
    def packed(s: pd.Series) -> pd.Series:
        return s.map(lambda x: np.asarray(x, kind).tobytes())

    # the row numbers are those of the stored table, hence the same for every reader
    classes = (cut_lineage(rows.filter("v is not null").groupBy("v")
                           .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
               .withColumn("node", F.monotonically_increasing_id()))
    different = classes.count()
    wanted = min(max_pivots, -(-different // block)) or 1
    chosen = classes.orderBy(F.xxhash64("node"), "node").limit(wanted).select("v").collect()
    by_dim: dict[int, list] = {}
    for r in chosen:
        by_dim.setdefault(len(r["v"]), []).append(np.asarray(r["v"], kind).tobytes())
    pivots = {d: _units(pd.Series(m), d, kind) for d, m in by_dim.items()}
    for d in [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect()]:
        if d not in pivots:  # a length that no pivot has: one cell around the first axis
            pivots[d] = np.eye(1, d)
    shared = spark.sparkContext.broadcast(_Pivots(pivots))

    def at_home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, part in _dims(f):
                dist = shared.value.distances(_units(part["raw"], dim, kind))
                home = dist.argmin(axis=1)
                yield part.assign(cell=shared.value.first[dim] + home,
                                  far=dist[np.arange(len(part)), home])

    homes = cut_lineage(
        classes.select("node", "copies", F.size("v").alias("dim"), packed("v").alias("raw"))
        .mapInPandas(at_home, "node long, copies long, dim int, raw binary, cell int, far double"))
    # one row for each pivot
    cells = {r["cell"]: (r["own"], r["far"]) for r in
             homes.groupBy("cell").agg(F.count("*").alias("own"), F.max("far").alias("far")).collect()}

    def visits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for f in frames:
            for dim, part in _dims(f):
                first, dist = p.first[dim], p.distances(_units(part["raw"], dim, kind))
                home = part["cell"].to_numpy() - first
                own = dist[np.arange(len(part)), home][:, None]
                reach = np.array([cells.get(first + q, (0, -np.inf))[1] for q in range(dist.shape[1])])
                go = ((dist <= own + 2 * radius + SLACK) & (dist <= radius + reach + SLACK)
                      & (dist ** 2 - own ** 2 <= 2 * radius * p.between[dim][home] + SLACK)
                      & (np.arange(dist.shape[1]) < home[:, None]))
                yield part[["node", "copies", "dim", "raw", "cell"]].assign(
                    visits=[(first + np.flatnonzero(g)).astype(np.int32) for g in go])

    placed = cut_lineage(homes.mapInPandas(
        visits, "node long, copies long, dim int, raw binary, cell int, visits array<int>"))
    guests = {r["cell"]: r["n"] for r in placed.select(F.explode("visits").alias("cell"))
              .groupBy("cell").agg(F.count("*").alias("n")).collect()}
    sizes = spark.createDataFrame(
        [(c, -(-own // block), -(-guests.get(c, 0) // block)) for c, (own, _) in cells.items()],
        "cell int, blocks int, chunks int")
    spot = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    vector = ["node", "copies", "raw"]
    residents = placed.drop("visits").join(F.broadcast(sizes), "cell").withColumn("at", spot)
    tile = lambda b, o, c, side: F.struct(b.alias("block"), F.lit(o).alias("other"), c.alias("chunk"),
                                          F.lit(side).alias("side"))
    at, blocks, chunks = F.col("at"), F.col("blocks"), F.col("chunks")
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    zero = F.lit(0)
    routes = F.concat(
        F.transform(upto(at, blocks - 1), lambda c: tile(at, 0, c, 0)),
        F.transform(upto(zero, at - 1), lambda b: tile(b, 0, at, 1)),
        F.transform(upto(zero, chunks - 1), lambda c: tile(at, 1, c, 0)))
    own_rows = residents.select("dim", "cell", F.explode(routes).alias("t"), *vector)
    visitors = (placed.select("dim", F.explode("visits").alias("cell"), *vector)
                .join(F.broadcast(sizes), "cell")
                .withColumn("to", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")))
    guest_rows = visitors.select("dim", "cell", F.explode(F.transform(
        upto(zero, blocks - 1), lambda b: tile(b, 1, F.col("to"), 1))).alias("t"), *vector)
    tiles = own_rows.union(guest_rows).select("dim", "cell", "t.*", *vector)
    found = cut_lineage(_join_tiles(tiles, min_cosine, kind))

    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("others"))
    labelled = (classes.join(roots, "node", "left").join(counts, "node", "left")
                .select("v", "rep", F.coalesce("component", "node").alias("root"),
                        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    smallest = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_vector = labelled.join(smallest, "root").select("v", "n_links", "component_id")
    return (rows.join(by_vector, "v", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
