"""Operator 12: exact near-duplicate vectors by a dual traversal of cover trees.

Equal vectors are one node with a multiplicity. On the unit sphere a cosine of t is a distance of
sqrt(2 - 2 t). The top of the tree is a set of pivots from a bounded sample, spread farthest-first:
each node lies in the cell of its nearest pivot, and two cells farther apart than the threshold plus
both radii never meet. A large cell is dealt into tiles of bounded size. Below, each run of at
most ``BLOCK`` nodes of a tile is one cover tree: nested levels of centres with halving radii, where a
level's centres are farther apart than its radius and every point has a centre of the level within it.

Two trees are descended together, level by level. With centres d apart and covering radii r and s (the
true ones, not the level's bound), a pair of nodes goes when d - r - s is over the threshold, is
linked as a whole when d + r + s is within it, and is opened otherwise. A dense cluster is thus counted
without listing its pairs. Screening is in single precision with a margin that covers its rounding;
single vectors are compared in double precision and, next to the threshold, in exact fractions, so the
pairs are exactly those at or above it.

Each pair of tiles is one task of bounded memory and sends on, for a node with links, their number
and one link to its component's smallest node. Vectors that lie all about equally far apart can't be
parted by any covering radius: for those, all pairs of tiles meet and work grows with their square.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite entries, link with nothing
and are their own component, with their own id; vectors of different lengths never link; equal vectors
link with each other; component_id is the smallest id of the component, null only if all its ids are;
kept says that the row has that id (null ids like any other); an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import scratch_table, small_batches
from ledgermart.llm.components import components

#: Nodes of one tree; nodes of a tile at most (about: cells are dealt by hash) and at least.
BLOCK, MOST_TILE, LEAST_TILE = 1024, 8192, 512
#: Tiles that even a small table is cut into, so that several tasks share the work.
TILES = 6
#: Nodes of the sample for the pivots, and pivots at most. Results don't depend on either.
SAMPLE, PIVOTS = 4096, 1024
#: Radii of the nested levels; all points are the last one.
RADII = [2.0**-k for k in range(-1, 6)]
#: Share of all pairs of two levels above which distances are one matrix product.
DENSE = 0.05


def sound(vector: Column) -> Column:
    """The vector can be compared."""
    return (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))) & F.exists(vector, lambda c: c != 0)


def plain(vectors: list) -> np.ndarray:
    """Rows as doubles, each times a power of two that keeps squares from over- and underflowing."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -exponent[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ y.T)))


def entered(distance: np.ndarray, most: int | None = None) -> tuple[list[int], list[int], np.ndarray]:
    """Points in the order in which they become centres, farthest first; the number of each level; parents."""
    n = len(distance)
    order, counts, parent = [0], [1], np.zeros(n, np.int64)
    least, nearest = distance[0].copy(), np.zeros(n, np.int64)
    least[0] = -1
    for radius in RADII[1:]:
        above = nearest.copy()
        while len(order) < (most or n):
            p = int(np.argmax(least))
            if least[p] <= radius:
                break
            parent[p] = above[p]
            order.append(p)
            closer = distance[p] < least
            least[closer], nearest[closer] = distance[p][closer], p
            least[p] = -1
        counts.append(len(order))
    inside = np.ones(n, bool)
    inside[order] = False
    rest = np.flatnonzero(inside)
    parent[rest] = nearest[rest]
    return [*order, *rest.tolist()], [*counts, n], parent


class CoverTree:
    """Points in order of entry, so that the centres of level l are the first counts[l] points."""

    def __init__(self, nodes: np.ndarray, times: np.ndarray, raw: np.ndarray, counts: list[int], parent: np.ndarray, radii: list[np.ndarray] | None = None):
        self.nodes, self.times, self.raw, self.counts, self.parent = nodes, times, raw, counts, parent
        self.unit = unit(raw)
        self.single = self.unit.astype(np.float32)
        self.levels = len(counts)
        self.up = [np.where(np.arange(k) < before, np.arange(k), parent[:k]) for before, k in zip([1, *counts[:-1]], counts)]
        self.above = [np.arange(len(nodes))]
        for up in self.up[:0:-1]:
            self.above.append(up[self.above[-1]])
        self.above.reverse()
        self.weight = [np.bincount(a, times, k).astype(np.int64) for a, k in zip(self.above, counts)]
        self.down = [np.argsort(up, kind="stable") for up in self.up[1:]]
        self.first = [np.searchsorted(up[d], np.arange(k + 1)) for up, d, k in zip(self.up[1:], self.down, counts)]
        self.radii = radii or self._radii()

    def _radii(self) -> list[np.ndarray]:
        out = []
        for a, k in zip(self.above, self.counts):
            radius = np.zeros(k)
            np.maximum.at(radius, a, np.sqrt(np.einsum("ij,ij->i", self.unit - self.unit[a], self.unit - self.unit[a])))
            out.append(radius.astype(np.float32))
        return out

    @classmethod
    def grown(cls, nodes: np.ndarray, times: np.ndarray, raw: np.ndarray) -> CoverTree:
        u = unit(raw)
        order, counts, parent = entered(apart(u, u))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(nodes[order], times[order], raw[order], counts, place[parent[order]])

    def children(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.first[level]
        return first[at], first[at + 1] - first[at]


def opened(a: CoverTree, b: CoverTree, level: int, i: np.ndarray, j: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children, on the next level, of pairs of nodes."""
    first_a, many_a = a.children(level, i)
    first_b, many_b = b.children(level, j)
    many = many_a * many_b
    pair = np.repeat(np.arange(len(i)), many)
    k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
    x = a.down[level][first_a[pair] + k // many_b[pair]]
    y = b.down[level][first_b[pair] + k % many_b[pair]]
    if same:  # a node with itself brings each pair of its children once
        once = (i[pair] != j[pair]) | (x <= y)
        x, y = x[once], y[once]
    return x, y


def at_least(a: np.ndarray, b: np.ndarray, threshold: Fraction) -> bool:
    """The cosine of two vectors of doubles reaches the threshold, exactly."""
    p, q = [Fraction(v) for v in a.tolist()], [Fraction(v) for v in b.tolist()]
    dot = sum(x * y for x, y in zip(p, q))
    right = threshold**2 * sum(x * x for x in p) * sum(y * y for y in q)
    return (dot >= 0 and dot * dot >= right) if threshold > 0 else (dot >= 0 or dot * dot <= right)


def descended(a: CoverTree, b: CoverTree, threshold: float, same: bool):
    """Yields (level, i, j): nodes of that level all of whose points are linked, or, on the last level, linked points."""
    if a.raw.shape[1] != b.raw.shape[1]:
        return
    reach = np.float32(math.sqrt(max(0.0, 2 - 2 * threshold)))
    margin = np.float32(max(1e-4, a.raw.shape[1] * 2.0**-22))
    exact = Fraction(str(threshold))
    i = j = np.zeros(1, np.int64)
    for level in range(a.levels):
        last = level == a.levels - 1
        r, s = a.radii[level], b.radii[level]
        ka, kb = a.counts[level], b.counts[level]
        if level:
            expected = int((a.children(level - 1, i)[1] * b.children(level - 1, j)[1]).sum())
            if expected > DENSE * ka * kb:
                near = a.single[:ka] @ b.single[:kb].T
                limit = np.minimum(r[:, None] + (s + reach), np.float32(2))
                np.multiply(limit, limit, out=limit)
                limit *= np.float32(-0.5)
                limit += np.float32(1) - margin
                keep = near >= limit
                parents = np.zeros((a.counts[level - 1], b.counts[level - 1]), bool)
                parents[i, j] = True
                if same:  # children of a pair may come in either order
                    parents |= parents.T
                if not parents.all():
                    keep &= parents[a.up[level][:, None], b.up[level]]
                if same:
                    keep = np.triu(keep)
                i, j = np.nonzero(keep)
                near = near[i, j]
            else:
                i, j = opened(a, b, level - 1, i, j, same)
                near = np.concatenate([np.einsum("ij,ij->i", a.single[i[k : k + 65536]], b.single[j[k : k + 65536]]) for k in range(0, max(1, len(i)), 65536)])
                limit = np.minimum(r[i] + s[j] + reach, np.float32(2))
                keep = near >= 1 - limit * limit / 2 - margin
                i, j, near = i[keep], j[keep], near[keep]
        else:
            near = np.einsum("ij,ij->i", a.single[i], b.single[j])
        if last:
            if same:
                i, j = i[i != j], j[i != j]
            cosine = np.concatenate([np.einsum("ij,ij->i", a.unit[i[k : k + 65536]], b.unit[j[k : k + 65536]]) for k in range(0, max(1, len(i)), 65536)])
            linked = cosine >= threshold
            for k in np.flatnonzero(np.abs(cosine - threshold) < 1e-12 * a.raw.shape[1]):
                linked[k] = at_least(a.raw[i[k]], b.raw[j[k]], exact)
            yield level, i[linked], j[linked]
            return
        inner = reach - r[i] - s[j]
        whole = (inner > 0) & (near >= 1 - inner * inner / 2 + margin)
        yield level, i[whole], j[whole]
        i, j = i[~whole], j[~whole]
        if not len(i):
            return


class Tally:
    """Links of a tree's points: by nodes whose points all have them, and whose points all hang together."""

    def __init__(self, tree: CoverTree):
        self.tree = tree
        self.links = [np.zeros(k, np.int64) for k in tree.counts]
        self.own = [np.zeros(k, bool) for k in tree.counts]
        self.bound = [np.zeros(k, bool) for k in tree.counts]

    def counted(self) -> np.ndarray:
        out = np.zeros(len(self.tree.nodes), np.int64)
        for above, links, own in zip(self.tree.above, self.links, self.own):
            out += links[above] - np.where(own[above], self.tree.times, 0)
        return out

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes, one, two = self.tree.nodes, [], []
        for above, bound in zip(self.tree.above, self.bound):
            at = np.flatnonzero(bound[above])
            one.append(nodes[at])
            two.append(nodes[above[at]])
        return np.concatenate(one), np.concatenate(two)


def tally(a: Tally, b: Tally, threshold: float) -> tuple[list, list]:
    """Adds the links between two trees (or within one) to both, and returns links between centres."""
    same, one, two = a is b, [], []
    for level, i, j in descended(a.tree, b.tree, threshold, same):
        itself = (i == j) if same else np.zeros(len(i), bool)
        a.own[level][i[itself]] = True
        np.add.at(a.links[level], i[itself], a.tree.weight[level][i[itself]])
        a.bound[level][i] = True
        b.bound[level][j] = True
        i, j = i[~itself], j[~itself]
        np.add.at(a.links[level], i, b.tree.weight[level][j])
        np.add.at(b.links[level], j, a.tree.weight[level][i])
        one.append(a.tree.nodes[i])
        two.append(b.tree.nodes[j])
    return one, two


def rooted(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of a list of links, and the smallest node that each hangs together with."""
    nodes, at = np.unique(np.concatenate([one, two]), return_inverse=True)
    x, y, label = at[: len(one)], at[len(one) :], np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        now = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(now, ends, least)
        now = now[now]
        if (now == label).all():
            return nodes, nodes[label]
        label = now


TREE = "tile int, dim int, nodes binary, times binary, raw binary, counts binary, parent binary, radii binary"


def packed(tile: int, tree: CoverTree) -> tuple:
    kinds = (np.int64, np.int64, np.float64, np.int64, np.int64, np.float32)
    parts = (tree.nodes, tree.times, tree.raw, np.array(tree.counts), tree.parent, np.concatenate(tree.radii))
    return (tile, tree.raw.shape[1], *[np.ascontiguousarray(p, k).tobytes() for p, k in zip(parts, kinds)])


def unpacked(row) -> CoverTree:
    counts = np.frombuffer(row.counts, np.int64).tolist()
    radii = np.split(np.frombuffer(row.radii, np.float32), np.cumsum(counts)[:-1])
    numbers = [np.frombuffer(x, np.int64) for x in (row.nodes, row.times, row.parent)]
    return CoverTree(numbers[0], numbers[1], np.frombuffer(row.raw, np.float64).reshape(-1, row.dim), counts, numbers[2], radii)


def nodes_of(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row a distinct sound vector: node, times, least (smallest id) and vector."""
    vector = F.col(vector_col).cast("array<double>")
    found = rows.select(F.col(id_col).alias("id"), vector.alias("vector")).where(sound(F.col("vector")))
    grouped = found.groupBy("vector").agg(F.count("*").alias("times"), F.min("id").alias("least"))
    return scratch_table(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")


def pivots_of(nodes: DataFrame, most: int) -> dict[int, np.ndarray]:
    """By length, unit vectors spread over a sample of at most SAMPLE nodes."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("vector").collect()
    out = {}
    for dim in {len(r["vector"]) for r in sample}:
        u = unit(plain([r["vector"] for r in sample if len(r["vector"]) == dim]))
        order, _, _ = entered(apart(u, u), min(most, len(u)))
        out[dim] = u[order[: min(most, len(u))]]
    return out


def trees_of(nodes: DataFrame, threshold: float) -> tuple[DataFrame, dict[int, tuple[int, int]], dict[int, list[int]]]:
    """The trees of all tiles; each cell's first tile and their number; each cell's partner cells."""
    count = nodes.count()
    size = max(LEAST_TILE, min(MOST_TILE, -(-count // TILES)))
    pivots = pivots_of(nodes, max(1, min(PIVOTS, count // size)))
    # a length that the sample lacks is one cell without a pivot
    first, start = {}, 1
    for dim, p in pivots.items():
        first[dim], start = start, start + len(p)

    def place(frames):
        for f in frames:
            if not len(f):
                continue
            dims = f["vector"].map(len)
            for dim, g in f.groupby(dims):
                x = plain(g["vector"].tolist())
                cell, away = np.zeros(len(g), np.int64), np.full(len(g), 2.0)
                if dim in pivots:
                    d = apart(unit(x), pivots[dim])
                    cell, away = first[dim] + d.argmin(axis=1), d.min(axis=1)
                yield pd.DataFrame({"node": g["node"], "times": g["times"], "cell": cell, "away": away, "dim": dim, "raw": [r.tobytes() for r in x]})

    placed = nodes.select("node", "times", "vector").mapInPandas(place, "node bigint, times bigint, cell bigint, away double, dim int, raw binary")
    placed = scratch_table(placed, "placed")
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.min("dim").alias("dim")).collect()}  # PIVOTS rows at most for each length of the sample
    tiles, at = {}, 0
    for cell in sorted(cells):
        tiles[cell] = (at, -(-cells[cell]["n"] // size))
        at += tiles[cell][1]
    reach, partners = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6, {}
    for cell, r in cells.items():
        partners[cell] = [0] if 0 in cells else []
        if cell:
            mine = first[r["dim"]]
            far = apart(pivots[r["dim"]][cell - mine : cell - mine + 1], pivots[r["dim"]])[0]
            partners[cell] += [mine + k for k in np.flatnonzero(far <= reach + r["radius"] + np.array([cells[mine + k]["radius"] if mine + k in cells else -9.0 for k in range(len(far))])).tolist()]
        else:
            partners[cell] = sorted(cells)

    dealt = nodes.sparkSession.createDataFrame([(c, *tiles[c]) for c in sorted(tiles)] or [(0, 0, 1)], "cell bigint, first int, tiles int")
    # at most PIVOTS + 1 rows for each length of the sample
    where = placed.join(F.broadcast(dealt), "cell").withColumn("tile", (F.col("first") + F.pmod(F.xxhash64("node"), F.col("tiles"))).cast("int")).drop("first", "tiles")

    def grow(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, g in f.groupby("dim"):
            g = g.sort_values(["away", "node"])
            for lo in range(0, len(g), BLOCK):
                part = g.iloc[lo : lo + BLOCK]
                raw = np.frombuffer(b"".join(part["raw"]), np.float64).reshape(-1, dim)
                out.append(packed(int(part["tile"].iloc[0]), CoverTree.grown(part["node"].to_numpy(), part["times"].to_numpy(), raw)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in TREE.split(", ")])

    trees = scratch_table(where.groupBy("tile").applyInPandas(grow, TREE), "trees")
    return trees, tiles, partners


def met(nodes: DataFrame, threshold: float, work, schema: str) -> DataFrame:
    """``work(low trees, high trees, same)`` for each pair of tiles that may hold links."""
    small_batches(nodes.sparkSession)
    trees, tiles, partners = trees_of(nodes, threshold)
    runs = [(tile, [list(tiles[p]) for p in partners[cell]]) for cell, (at, many) in tiles.items() for tile in range(at, at + many)]
    meets = nodes.sparkSession.createDataFrame(runs or [(0, [[0, 1]])], "tile int, runs array<array<int>>")
    others = F.flatten(F.transform("runs", lambda r: F.sequence(r[0], r[0] + r[1] - 1)))
    dealt = trees.join(meets, "tile").withColumn("other", F.explode(others)).drop("runs")
    dealt = dealt.select(F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "dim", "nodes", "times", "raw", "counts", "parent", "radii")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        same = f["low"].iloc[0] == f["high"].iloc[0]
        f = f.sort_values("nodes", kind="stable")
        held = [(row.tile == row.low, unpacked(row)) for row in f.itertuples(index=False)]
        return work([t for low, t in held if low], [t for low, t in held if same or not low], same)

    return dealt.groupBy("low", "high").applyInPandas(run, schema)


def links_of(nodes: DataFrame, threshold: float) -> DataFrame:
    """Per node with links, for each pair of tiles: node, links (rows linked with it) and root."""

    def work(low, high, same):
        a = [Tally(t) for t in low]
        b = a if same else [Tally(t) for t in high]
        one, two = [], []
        for x, left in enumerate(a):
            for right in b[x:] if same else b:
                found = tally(left, right, threshold)
                one += found[0]
                two += found[1]
        all_of = a if same else a + b
        for t in all_of:
            p, q = t.edges()
            one.append(p)
            two.append(q)
        if not one:
            return pd.DataFrame({"node": [], "links": [], "root": []})
        nodes, roots = rooted(np.concatenate(one), np.concatenate(two))
        counted = pd.Series(np.concatenate([t.counted() for t in all_of]), np.concatenate([t.tree.nodes for t in all_of]))
        return pd.DataFrame({"node": nodes, "links": counted.loc[nodes].to_numpy(), "root": roots})

    return met(nodes, threshold, work, "node bigint, links bigint, root bigint")


def pairs(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Linked pairs of different vectors: a and b (the smallest ids that have them) and cosine.

    Equal vectors are one class and aren't paired with each other; its rows are those with an equal vector.
    """
    nodes = nodes_of(rows, id_col, vector_col)

    def work(low, high, same):
        out = []
        for x, left in enumerate(low):
            for right in high[x:] if same else high:
                own = same and left is right
                for level, i, j in descended(left, right, threshold, own):
                    for p, q in zip(i.tolist(), j.tolist()):
                        one = np.flatnonzero(left.above[level] == p)
                        two = np.flatnonzero(right.above[level] == q)
                        s, t = np.repeat(one, len(two)), np.tile(two, len(one))
                        if own and p == q:
                            s, t = s[s < t], t[s < t]
                        out.append(pd.DataFrame({"x": left.nodes[s], "y": right.nodes[t], "cosine": np.einsum("ij,ij->i", left.unit[s], right.unit[t])}))
        return pd.concat(out) if out else pd.DataFrame({"x": [], "y": [], "cosine": []})

    found = met(nodes, threshold, work, "x bigint, y bigint, cosine double")
    one, two = nodes.select(F.col("node").alias("x"), F.col("least").alias("p")), nodes.select(F.col("node").alias("y"), F.col("least").alias("q"))
    return found.join(one, "x").join(two, "y").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "cosine")


def near_dedup(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id and kept."""
    nodes = nodes_of(rows, id_col, vector_col)
    found = scratch_table(links_of(nodes, threshold), "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    label = nodes.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = scratch_table(label.select("vector", "root", "least", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vector-labels")
    least = label.groupBy("root").agg(F.min("least").alias("component_id"))
    label = label.drop("least").join(least, "root").drop("root")
    all_rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.coalesce(sound(F.col("vector")), F.lit(False))
    alone = all_rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = all_rows.where(usable).join(label, "vector").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
