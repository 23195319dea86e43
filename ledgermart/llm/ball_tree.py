"""Operator 11: exact ranked lexical search with sparse ball trees.

A document is a sparse vector over the terms of the items: weight times saturated frequency, in
64-bit integers. An item is the 0/1 vector of its terms, so a score is an inner product. Documents
are dealt out by their two heaviest terms and cut into blocks; each block is one tree whose nodes
hold a centroid c and a radius r. No document x below a node scores more than c.q + |q| r, which is
widened for rounding, so subtrees below an item's k-th best score are left out without losing a row.
An item visits nodes best-first; leaves are scored in exact integers. A task keeps each item's k best
over all its blocks, so later trees are cut earlier, and sends on only those.

Items are worked off in blocks of at most ``VOCABULARY`` terms (a longer item is a block of its
own), each against all documents; what a worker holds of the items is bounded that way, and no item
is left out.

Edge cases: null texts and texts without terms have no vector and count neither in N nor in L; items
without terms, and terms that no document holds, find nothing; each row of either table counts by
itself, also with an equal or null id; equal scores go by ascending id, null ids last; a term in
every document may weigh 0; empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermart.llm.common import scratch_table, small_batches

#: Terms of the items that are searched together, and items of one block.
VOCABULARY, ITEMS = 8192, 4096
#: Documents of one tree, and of a leaf.
TREE, LEAF = 4096, 64
#: Numbers that the centroids of a tree hold at most; wide vocabularies get smaller trees.
CENTROIDS = 1 << 22
#: Relative widening of the bounds; sums of fewer than a million doubles err by less.
SLACK = 1e-9

#: Bytes of terms stay (A-Z lower-cased, all of UTF-8's other bytes as they are), all others part them.
PARTED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PARTED).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Block:
    """Some items: their terms numbered, and each item's distinct terms."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.items: list[tuple[str | None, np.ndarray]] = []

    def add(self, item_id: str | None, words: set[bytes]) -> None:
        self.items.append((item_id, np.array(sorted(self.number.setdefault(w, len(self.number)) for w in words), np.int64)))

    def takes(self, words: set[bytes]) -> bool:
        return not self.items or (len(self.items) < ITEMS and len(self.number) + len(words) <= VOCABULARY)


def blocks_of(items: DataFrame, item_col: str, text_col: str) -> Iterator[Block]:
    """The items in blocks; rows come to the driver a partition at a time."""
    block = Block()
    for row in items.select(F.col(item_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).toLocalIterator():
        words = set(terms_of(row["text"]))
        if not words:
            continue
        if not block.takes(words):
            yield block
            block = Block()
        block.add(row["id"], words)
    if block.items:
        yield block


def occurrences(docs: DataFrame, block: Block) -> DataFrame:
    """Per document: doc_id (as a string), n terms, and its terms among the block's with their counts."""
    number = block.number

    def run(batches):
        for batch in batches:
            length, ends, terms, counts = [], [0], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                length.append(len(words))
                for word, times in Counter(words).items():
                    at = number.get(word)
                    if at is not None:
                        terms.append(at)
                        counts.append(times)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(length, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id string, n bigint, terms array<bigint>, counts array<bigint>")


def vectors(found: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """doc_id, terms, values (weight times saturated frequency) and the two heaviest terms; documents of value 0 go."""

    def run(batches):
        for batch in batches:
            n, terms, counts = batch.column("n").to_numpy(), batch.column("terms"), batch.column("counts")
            ends = terms.offsets.to_numpy()
            ends = ends - ends[0]
            term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            sizes = np.diff(ends)
            m = np.array([10 + 90 * int(x) * documents // length for x in n], np.int64)
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes)))
            owner = np.repeat(np.arange(len(n)), sizes)
            held = value > 0
            owner, term, value = owner[held], term[held], value[held]
            order = np.lexsort((term, -value, owner))
            owner, term, value = owner[order], term[order], value[order]
            rows, starts, sizes = np.unique(owner, return_index=True, return_counts=True)
            ends = pa.array(np.append(starts, len(owner)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (term, value)]
            second = np.where(sizes > 1, term[np.minimum(starts + 1, max(len(term) - 1, 0))], -1) if len(rows) else sizes
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *lists, pa.array(term[starts]), pa.array(second.astype(np.int64))], ["doc_id", "terms", "vals", "first", "second"])

    return found.select("doc_id", "n", "terms", "counts").mapInArrow(run, "doc_id string, terms array<bigint>, vals array<bigint>, first bigint, second bigint")


class BallTree:
    """Rows (starts, terms, vals) in tree order; nodes with lo, hi, children, centroid and radius."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, vals: np.ndarray, width: int):
        self.width = width
        self.starts, self.terms, self.vals = starts, terms, vals
        self.sizes = np.diff(starts)
        self.norms = np.add.reduceat(vals.astype(np.float64) ** 2, starts[:-1])
        order = np.arange(len(self.sizes))
        self.lo, self.hi, self.child, self.centroid, self.radius = [], [], [], [], []
        self._grow(order, 0, len(order))
        # rows now follow the tree, so that each node is one run
        picked, sizes = self._entries(order)
        self.order, self.terms, self.vals = order, terms[picked], vals[picked]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.centroid, self.radius = np.stack(self.centroid), np.array(self.radius)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - sizes), sizes), sizes

    def _grow(self, order: np.ndarray, lo: int, hi: int) -> int:
        node, rows = len(self.lo), order[lo:hi]
        picked, sizes = self._entries(rows)
        terms, vals, begin = self.terms[picked], self.vals[picked].astype(np.float64), np.cumsum(sizes) - sizes

        def dot(dense: np.ndarray) -> np.ndarray:
            return np.add.reduceat(dense[terms] * vals, begin)

        centre = np.bincount(terms, vals, self.width) / len(rows)
        # |x - c|^2, with what rounding may take from it given back
        away = self.norms[rows] - 2 * dot(centre) + centre @ centre
        spare = SLACK * (self.norms[rows].max() + centre @ centre)
        self.lo.append(lo)
        self.hi.append(hi)
        self.child.append(())
        self.centroid.append(centre)
        self.radius.append(math.sqrt(max(0.0, away.max()) + spare))
        if hi - lo <= LEAF:
            return node
        far = np.zeros((2, self.width))
        a = int(np.argmax(away))
        far[0][terms[begin[a] : begin[a] + sizes[a]]] = vals[begin[a] : begin[a] + sizes[a]]
        b = int(np.argmax(self.norms[rows] - 2 * dot(far[0])))
        far[1][terms[begin[b] : begin[b] + sizes[b]]] = vals[begin[b] : begin[b] + sizes[b]]
        order[lo:hi] = rows[np.argsort(dot(far[1] - far[0]), kind="stable")]
        middle = (lo + hi) // 2
        self.child[node] = (self._grow(order, lo, middle), self._grow(order, middle, hi))
        return node

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """For each node, what no row below it can exceed."""
        return (self.centroid[:, terms].sum(axis=1) + math.sqrt(len(terms)) * self.radius) * (1 + SLACK) + 1

    def scores(self, node: int, asked: np.ndarray) -> np.ndarray:
        """Exact scores of a node's rows; ``asked`` is the item's 0/1 vector."""
        run = self.starts[self.lo[node] : self.hi[node] + 1]
        part = slice(run[0], run[-1])
        return np.add.reduceat(self.vals[part] * asked[self.terms[part]], run[:-1] - run[0])


class Best:
    """An item's k best rows so far: highest score, then lowest key."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def least(self) -> int:
        """Rows below this score can't enter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def offer(self, scores: np.ndarray, rows: np.ndarray, keys: list) -> None:
        at = np.flatnonzero(scores >= self.least())
        if len(at):
            self.rows = sorted([*self.rows, *[(-int(scores[i]), keys[rows[i]]) for i in at]])[: self.k]


def descend(tree: BallTree, terms: np.ndarray, asked: np.ndarray, best: Best, keys: list) -> int:
    """Best-first search of one tree for one item; the number of leaves that were scored."""
    bounds, scored = tree.bounds(terms), 0
    queue = [(-bounds[0], 0)]
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < best.least():
            break
        if tree.child[node]:
            for child in tree.child[node]:
                heapq.heappush(queue, (-bounds[child], child))
        else:
            scored += 1
            best.offer(tree.scores(node, asked), tree.order[tree.lo[node] : tree.hi[node]], keys)
    return scored


def key_of(kind: T.DataType):
    """Ids, which travel as strings, in the order of their type; nulls last."""
    read = int if isinstance(kind, T.IntegralType) else float if isinstance(kind, (T.FractionalType,)) else str.encode
    return lambda x: (x is None, read(x) if x is not None else 0, x)


def nearest(rows: DataFrame, block: Block, k: int, kind: T.DataType) -> DataFrame:
    """item, item_id, doc_id and score: each task's k best rows for each item of the block."""
    width, items, key = len(block.number), block.items, key_of(kind)
    trees = max(LEAF, min(TREE, CENTROIDS // width * LEAF // 4))

    def run(batches):
        best = [Best(k) for _ in items]
        asked = np.zeros(width, np.int64)

        def search(ids, sizes, terms, vals):
            tree = BallTree(np.concatenate([[0], np.cumsum(sizes)]), terms, vals, width)
            keys = [key(x) for x in ids]
            for (_, of), mine in zip(items, best):
                asked[of] = 1
                descend(tree, of, asked, mine, keys)
                asked[of] = 0

        held, count = [], 0
        for batch in batches:
            lists, vals = batch.column("terms"), batch.column("vals")
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten().to_numpy(), vals.flatten().to_numpy()
            ids, lo = batch.column("doc_id").to_pylist(), 0
            while lo < len(ids):
                hi = min(len(ids), lo + trees - count)
                part = slice(ends[lo], ends[hi])
                held.append((ids[lo:hi], np.diff(ends[lo : hi + 1]), flat[0][part], flat[1][part]))
                count, lo = count + hi - lo, hi
                if count == trees:
                    search(sum((h[0] for h in held), []), *[np.concatenate([h[i] for h in held]) for i in (1, 2, 3)])
                    held, count = [], 0
        if count:
            search(sum((h[0] for h in held), []), *[np.concatenate([h[i] for h in held]) for i in (1, 2, 3)])
        out = [(i, items[i][0], row[1][2], -row[0]) for i, mine in enumerate(best) for row in mine.rows]
        columns = zip(*out) if out else ([], [], [], [])
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["item", "item_id", "doc_id", "score"])

    near = rows.repartitionByRange("first", "second", F.xxhash64("doc_id")).sortWithinPartitions("first", "second")
    return near.select("doc_id", "terms", "vals").mapInArrow(run, "item bigint, item_id string, doc_id string, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` highest-scoring documents above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    kind, item_kind = docs.schema[id_col].dataType, items.schema[item_col].dataType
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], T.StructType([T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]))
    for block in blocks_of(items, item_col, item_text_col):
        found = scratch_table(occurrences(source, block), "occurrences")
        total = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length")).first()
        if not total["documents"]:
            return out
        weights = np.zeros(len(block.number), np.int64)
        for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the block
            weights[row["term"]] = weight(total["documents"], row["count"])
        rows = scratch_table(vectors(found, weights, total["documents"], total["length"]), "vectors")
        mine = nearest(rows, block, k, kind).withColumn("doc_id", F.col("doc_id").cast(kind))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out = out.unionByName(ranked.select(F.col("item_id").cast(item_kind).alias("item_id"), "rank", "doc_id", "score"))
    return out
