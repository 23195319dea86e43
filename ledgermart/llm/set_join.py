"""Operator 5: size-aware heavy-light similarity join on word n-gram sets, with Jaccard >= T %.

Equal sets are one node. For two sets of sizes a and b, T % Jaccard means an overlap of at least
c(a, b) shingles, or a symmetric difference of at most a + b - 2 c(a, b).

*Light* sets (up to a boundary size) enumerate all their subsets of c shingles, for each size of a
partner. Sets with an equal subset are linked without any further check.

*Heavy* sets go into inverted lists. With at most d differing shingles and the shingles dealt
into p parts by hash, two linked sets agree on p - d whole parts at least; a list holds the sets that
agree on one part. p is somewhat above d, so that chance agreements are too few. Size classes (each
reaching as far as a partner can) make p the same for both. Parts without a shingle say little and
aren't listed, unless a set has so many that the others might not meet.

The parts are dealt into slices, few enough differences each: of d differing shingles some slice has
d over the number of slices at most, and in that slice linked sets agree on nearly all parts. A parity
sketch of the set's shingles in the slice bounds their difference there from below, exactly, so it
drops pairs without losing a link, however large the sets are. Members carry the short names of all
parts of their slice too: a pair must agree on as many as linked sets do, and is sent on from its first
two common lists only, not from each.

The boundary is the size with the least cost: rows of subsets against rows of lists and their checks,
over the counts of small texts by size.

Links only matter for who is reachable, so not all pairs are checked. First every member of a list is
held against the list's first one, and each set against the smallest of those that it may be linked with,
which is linear in the lists; overlaps are counted exactly and
the links' components found. Then each list names only the pairs that would join its different components
into trees, fewer than it has components; they are counted and the components found anew. What is left,
pairs of a list whose ends still lie in different components, is checked whole; pairs inside a component
aren't even enumerated. Every other possible link has been tested.

Lists longer than ``block`` are cut into blocks. Members of a list's largest component stay in
their block and meet the others there, which go to all blocks in runs; so no list needs to fit into one
task, and a cluster of copies isn't dealt out. Copies inside a task are dropped before the shuffle.

Edge cases: null and empty texts have the empty set, link with nothing and are their own
component, as are all texts without words; equal ids are one node only if their sets link;
component_id is the smallest id of the component (null only if all its ids are); an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm import bloom
from ledgermart.llm.bitmaps import bitmap_of, bits_for, marked
from ledgermart.llm.common import ids_and_texts, let_go, scratch_table, small_batches, text_of
from ledgermart.llm.components import components
from ledgermart.llm.shingles import MIX, mixed, shingle_sets

#: Shingles that may differ in a slice, at most. Sketches have a power of two of bits, at least
#: LEAST_BITS, and BITS_PER_DIFFERENCE for each of these shingles, which makes 1,024 at most.
SLICE_DIFFERENCES, LEAST_BITS, BITS_PER_DIFFERENCE = 40, 256, 24
#: Parts beyond the one that linked sets share at least: one for so many shingles that may differ.
DIFFERENCES_PER_SPARE_PART = 8
#: Members of an inverted list that one task compares with as many others.
BLOCK = 2048
#: Light sets are at most this large whatever the cost says (subsets grow fast).
MOST_LIGHT = 40
#: Cost of a list's row against a subset's row: it is scanned, and its pairs are checked later.
LIST_COST = 3.0
#: Node names that a task remembers to drop copies before the shuffle.
REMEMBER = 1 << 20


class Sizes:
    """What a threshold of ``percent`` says about sizes."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("the threshold is above 50 %, at most 100 %")
        self.percent = percent
        self.floors = [1]

    def overlap(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def partners(self, a: int) -> range:
        """Sizes that a set of size ``a`` can be linked with."""
        return range(-(-self.percent * a // 100), a * 100 // self.percent + 1)

    def floor(self, g: int) -> int:
        """Smallest size of class ``g``; partners of a class lie in it or next to it."""
        while len(self.floors) <= g:
            low = self.floors[-1]
            self.floors.append(max(low + 1, (low - 1) * 100 // self.percent + 1))
        return self.floors[g]

    def class_of(self, a: int) -> int:
        while self.floors[-1] <= a:
            self.floor(len(self.floors))
        return int(np.searchsorted(self.floors, a, side="right")) - 1

    def differing(self, g: int) -> int:
        """Shingles that linked sets up to class ``g`` can differ in."""
        most = self.floor(g + 1) - 1
        return 2 * most * (100 - self.percent) // (100 + self.percent)

    def parts(self, g: int) -> int:
        """Parts of a set in the lists of class ``g``: more than two linked sets can differ in."""
        return self.differing(g) + 1 + self.differing(g) // DIFFERENCES_PER_SPARE_PART

    def slices(self, g: int) -> int:
        return max(1, -(-self.differing(g) // SLICE_DIFFERENCES))

    def bits(self, g: int) -> int:
        return max(LEAST_BITS, 1 << (BITS_PER_DIFFERENCE * (self.differing(g) // self.slices(g))).bit_length())

    def stride(self, g: int) -> int:
        """Bytes of a slice: its sketch and four for each of its parts."""
        return self.bits(g) // 8 + 4 * -(-self.parts(g) // self.slices(g))

    def subsets(self, a: int, boundary: int) -> int:
        return sum(comb(a, self.overlap(a, b)) for b in self.partners(a) if b <= boundary and self.overlap(a, b) <= min(a, b))


def boundary_by_cost(counts: dict[int, int], sizes: Sizes) -> int:
    """The size up to which enumerating subsets costs less than lists."""

    def cost(x: int) -> float:
        total = 0.0
        for a, n in counts.items():
            if a <= x:
                total += n * sizes.subsets(a, x)
            if sizes.partners(a).stop - 1 > x:
                g = sizes.class_of(a)
                total += LIST_COST * n * (sizes.parts(g) + sizes.parts(g + 1))
        return total

    return min(range(1, MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def parts_in_slice(parts, slices, at):
    """Parts whose number is ``at`` modulo ``slices``."""
    return parts // slices + (at < parts % slices)


def part_keys(shingles: np.ndarray, parts: int, g: int) -> tuple[np.ndarray, np.ndarray]:
    """The list key of each part of a set in class ``g``, and which parts have no shingle."""
    part = (mixed(shingles ^ MIX) >> np.uint64(33)) % np.uint64(parts)
    held = np.zeros(parts, np.uint64)
    np.add.at(held, part.astype(np.int64), mixed(shingles + MIX))
    key = mixed(held + mixed(np.arange(parts, dtype=np.uint64) + np.uint64((g + 1) << 32)))
    return key, np.bincount(part.astype(np.int64), minlength=parts) == 0


def few_empty(empty, parts, slices, at, differing):
    """Of the parts that linked sets agree on in a slice, one has a shingle if either set has so few empty ones."""
    return empty < parts_in_slice(parts, slices, at) - differing // slices


def postings_of(shingles: np.ndarray, sizes: Sizes, boundary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list keys, kinds, places) of a set.

    Kind: class of a heavy list, or minus the smaller size of a light one. Place, of a heavy list: the
    part's slice, the set's empty parts in it, whether the class is the one above the set's own, the
    binary logarithm of the sketch's size over the least one, and the bytes of a slice.
    """
    n, keys, kinds, places = len(shingles), [], [], []
    values = mixed(shingles + MIX)
    if n <= boundary:
        total = values.sum(dtype=np.uint64)
        for b in sizes.partners(n):
            lo, hi = min(n, b), max(n, b)
            c = sizes.overlap(n, b)
            if b > boundary or c > lo:
                continue
            gone = np.array([values[list(out)].sum(dtype=np.uint64) for out in combinations(range(n), n - c)], np.uint64)
            keys.append(mixed(total - gone + np.uint64(lo << 20 | hi)))
            kinds.append(np.full(len(gone), -lo))
            places.append(np.zeros(len(gone), np.int64))
    if sizes.partners(n).stop - 1 > boundary:
        where = mixed(shingles ^ MIX) >> np.uint64(33)
        own = sizes.class_of(n)
        for g in (own, own + 1):
            p, k = sizes.parts(g), sizes.slices(g)
            key, bare = part_keys(shingles, p, g)
            at = np.arange(p) % k
            empty = np.bincount(at, bare, k).astype(np.int64)
            listed = ~(bare & few_empty(empty, p, k, np.arange(k), sizes.differing(g))[at])
            keys.append(key[listed])
            kinds.append(np.full(int(listed.sum()), g))
            places.append((at << 20 | empty[at] << 12 | (g > own) << 11 | (sizes.bits(g) // LEAST_BITS).bit_length() - 1 << 9 | sizes.stride(g))[listed])
    none = np.zeros(0, np.int64)
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), (np.concatenate(kinds) if kinds else none), (np.concatenate(places) if places else none)


def node_of(shingles: np.ndarray) -> np.ndarray:
    """A 64-bit name of the set, as a signed number."""
    return mixed(np.array([mixed(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64)).view(np.int64)


def slices_of(shingles: np.ndarray, sizes: Sizes, g: int) -> bytes:
    """For each slice of class ``g``: a sketch, and the lower halves of its parts' keys.

    The sketch has the parities of the shingles' counts in a power of two of cells, so a differing
    shingle flips one bit of its slice's.
    """
    p, k, bits = sizes.parts(g), sizes.slices(g), sizes.bits(g)
    at = (mixed(shingles ^ MIX) >> np.uint64(33)) % np.uint64(p) % np.uint64(k)
    cells = at * np.uint64(bits) + mixed(shingles + np.uint64(7)) % np.uint64(bits)
    sketch = np.packbits(np.bincount(cells.astype(np.int64), minlength=k * bits) & 1).reshape(k, -1)
    names = np.zeros(k * -(-p // k), np.uint32)
    names[:p] = part_keys(shingles, p, g)[0].astype(np.uint32)
    names = np.ascontiguousarray(names.reshape(-1, k).T)
    return np.concatenate([sketch, names.view(np.uint8).reshape(k, -1)], axis=1).tobytes()


def described(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc_id (as a string), name (hash of id and text), n_shingles and node."""

    def run(frames):
        let_go()
        for f in frames:
            found = shingle_sets(f["text"].tolist(), width)
            yield pd.DataFrame({"doc_id": f["doc_id"], "name": f["name"], "n_shingles": [len(s) for s in found], "node": [node_of(s)[0] for s in found]})

    return docs.mapInPandas(run, "doc_id string, name bigint, n_shingles bigint, node bigint")


def texts_of_sets(nodes: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The text of one document of each set of ``nodes``, and of a few others.

    It is found again by a Bloom filter over its name: only texts that are needed (and a few false
    alarms) move, and as texts, which compress better than hashes.
    """
    named = sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("name").alias("name"))
    names = scratch_table(named.select(F.xxhash64("name").alias("hash")), "names")
    segments = bloom.segments_for(names.count())
    found = scratch_table(bloom.filter_of(names, segments), "names-bloom")
    return bloom.looked_up(docs.select("text", "name").withColumn("hash", F.xxhash64("name")), found, segments, "once").where("maybe").select("text")


def sketched(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Per set: node and the slices of both its classes, ``own`` and ``above``."""
    sizes = Sizes(percent)

    def run(frames):
        for f in frames:
            found = [s for s in shingle_sets(f["text"].tolist(), width) if len(s)]
            own, above = ([slices_of(s, sizes, sizes.class_of(len(s)) + up) for s in found] for up in (0, 1))
            yield pd.DataFrame({"node": [node_of(s)[0] for s in found], "own": own, "above": above}).drop_duplicates("node")

    rows = texts.mapInPandas(run, "node bigint, own binary, above binary")
    return rows.groupBy("node").agg(F.first("own").alias("own"), F.first("above").alias("above"))


def with_pieces(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """``members`` of lists with ``sketch``, the slice of their list's class. Slices are wide, so they come last."""
    piece = F.expr("substring(if(place & 2048 <> 0, above, own), cast((place >> 20) * (place & 511) + 1 as int), cast(place & 511 as int))")
    return members.join(sketches, "node").withColumn("sketch", piece).drop("own", "above")


def postings(docs: DataFrame, width: int, sizes: Sizes, boundary: int) -> DataFrame:
    """key, node, info (size and kind) and place, once per set and task as far as the task remembers."""

    def run(frames):
        seen: set[int] = set()
        for f in frames:
            keys, nodes, infos, places = [], [], [], []
            for s in shingle_sets(f["text"].tolist(), width):
                node = int(node_of(s)[0])
                if len(s) and node not in seen:
                    if len(seen) >= REMEMBER:
                        seen.clear()
                    seen.add(node)
                    k, kind, place = postings_of(s, sizes, boundary)
                    keys.append(k.view(np.int64))
                    nodes.append(np.full(len(k), node))
                    infos.append(np.int64(len(s) << 16) + kind + 32768)
                    places.append(place)
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "node": np.concatenate(nodes), "info": np.concatenate(infos), "place": np.concatenate(places)})

    return docs.select("text").mapInPandas(run, "key bigint, node bigint, info bigint, place bigint")


LISTED = "key bigint, node bigint, n bigint, kind bigint, place bigint, block bigint, head bigint, head_n bigint"


def shared_lists(posted: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members of lists with two sets or more: key, node, n, kind, place, block, head (the list's first node and size)."""

    def run(frames):
        last = None  # the last row of the batch before, not yet sent if its list had one set so far
        key, node, info, rank, head, pending = 0, 0, 0, -1, None, None
        for f in frames:
            k, v, w, x = f["key"].to_numpy(), f["node"].to_numpy(), f["info"].to_numpy(), f["place"].to_numpy()
            fresh = np.ones(len(k), bool)
            fresh[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
            if last is not None and len(k):
                fresh[0] = (k[0], v[0]) != last
            if len(k):
                last = (k[-1], v[-1])
            k, v, w, x = k[fresh], v[fresh], w[fresh], x[fresh]
            if not len(k):
                continue
            begins = np.ones(len(k), bool)
            begins[1:] = k[1:] != k[:-1]
            goes_on = rank >= 0 and k[0] == key
            begins[0] = not goes_on
            at = np.arange(len(k))
            start = np.maximum.accumulate(np.where(begins, at, -1))
            ranks = np.where(start < 0, at + rank + 1, at - start)
            heads = v[np.maximum(start, 0)]
            sizes = w[np.maximum(start, 0)] >> 16
            if goes_on:
                heads[start < 0], sizes[start < 0] = head
            alone = begins & np.concatenate([begins[1:], [False]])
            send = ~alone
            send[-1] = send[-1] and not begins[-1]
            rows = np.column_stack([k, v, w, x, ranks, heads, sizes])[send]
            if goes_on and pending is not None:
                rows = np.concatenate([[pending], rows])
            pending = (k[-1], v[-1], w[-1], x[-1], ranks[-1], heads[-1], sizes[-1]) if begins[-1] else None
            key, rank, head = k[-1], int(ranks[-1]), (heads[-1], sizes[-1])
            yield pd.DataFrame({"key": rows[:, 0], "node": rows[:, 1], "n": rows[:, 2] >> 16, "kind": (rows[:, 2] & 0xFFFF) - 32768, "place": rows[:, 3], "block": rows[:, 4] // block, "head": rows[:, 5], "head_n": rows[:, 6]})

    sorted_lists = posted.repartition("key").sortWithinPartitions("key", F.shiftright("info", 16), "node")
    return sorted_lists.mapInPandas(run, LISTED)


class Rows:
    """Members of lists as arrays, and which pairs of them may be linked."""

    def __init__(self, f: pd.DataFrame, percent: int):
        self.node, self.n, self.kind = f["node"].to_numpy(), f["n"].to_numpy(), f["kind"].to_numpy()
        place = f["place"].to_numpy()
        self.slice, self.empty, self.percent = place >> 20, place >> 12 & 63, percent
        sizes = Sizes(percent)
        sizes.class_of(int(self.n.max()) + 1)
        self.own = np.searchsorted(np.array(sizes.floors), self.n, side="right") - 1
        self.slices, all_parts, differing, self.parts = (np.zeros(len(f), np.int64) for _ in range(4))
        pieces = f["sketch"].to_numpy()
        self.sketch = np.zeros((len(f), 16), np.uint64)
        self.names = np.zeros((len(f), 64), np.uint32)
        bare = np.zeros((len(f), 64), bool)
        for g in np.unique(self.kind).tolist():
            at = np.flatnonzero(self.kind == g)
            k, p, size = sizes.slices(g), sizes.parts(g), sizes.bits(g) // 8
            raw = np.frombuffer(b"".join(pieces[at]), np.uint8).reshape(len(at), -1)
            self.sketch[at, : size // 8] = np.ascontiguousarray(raw[:, :size]).view(np.uint64)
            if raw.shape[1] == size:  # a sketch alone
                self.slices[at], all_parts[at] = k, p
                continue
            held = -(-p // k)
            self.names[at, :held] = np.ascontiguousarray(raw[:, size:]).view(np.uint32)
            self.slices[at], all_parts[at], differing[at] = k, p, sizes.differing(g)
            none = np.zeros(k * held, np.uint32)
            none[:p] = part_keys(np.zeros(0, np.uint64), p, g)[0].astype(np.uint32)
            bare[at, :held] = self.names[at, :held] == none.reshape(-1, k).T[self.slice[at]]
        self.parts = parts_in_slice(all_parts, self.slices, self.slice)
        real = np.arange(64) < self.parts[:, None]
        # parts of a list that a partner can be met in
        self.listed = real & ~(bare & few_empty(self.empty, all_parts, self.slices, self.slice, differing)[:, None])
        self.real = real
        own = f["key"].to_numpy().astype(np.uint64).astype(np.uint32)
        self.at = (self.listed & (self.names == own[:, None])).argmax(axis=1)

    def allowed(self, i: np.ndarray, j: np.ndarray, once: bool = False) -> np.ndarray:
        """Which pairs of rows of one list the sizes and sketches allow; with ``once`` the common parts too, in their first two lists only."""
        total = self.n[i] + self.n[j]
        most = total - 2 * -(-self.percent * total // (100 + self.percent))
        # in the list of class g one set is of that class; pairs below meet in their own class's list
        ok = (np.maximum(self.own[i], self.own[j]) == self.kind[i]) & (most >= 0) & (np.abs(self.n[i] - self.n[j]) <= most)
        at = np.flatnonzero(ok)
        here = most[at] // self.slices[i[at]]
        near = np.bitwise_count(self.sketch[i[at]] ^ self.sketch[j[at]]).sum(axis=1) <= here
        ok[at[~near]] = False
        if not once:
            return ok
        at, here = at[near], here[near]
        same = self.names[i[at]] == self.names[j[at]]
        enough = (same & self.real[i[at]]).sum(axis=1) >= self.parts[i[at]] - here
        # a chance agreement of two names may hide one list, hardly ever two
        before = np.arange(64) < self.at[i[at]][:, None]
        enough &= (same & self.listed[i[at]] & self.listed[j[at]] & before).sum(axis=1) < 2
        ok[at[~enough]] = False
        return ok


def whole_groups(frames, names: list[str]):
    """Frames cut where a group (equal values of ``names``) ends; a frame holds one group at least."""
    held = None
    for f in frames:
        f = f if held is None else pd.concat([held, f], ignore_index=True)
        if not len(f):
            continue
        last = (f[names] == f[names].iloc[-1]).all(axis=1)
        held, ready = f[last], f[~last].reset_index(drop=True)
        if len(ready):
            yield ready
    if held is not None and len(held):
        yield held.reset_index(drop=True)


def cut(members: DataFrame) -> DataFrame:
    """The number of blocks of each list that has several: key, blocks."""
    return members.where("block > 0").groupBy("key").agg((F.max("block") + 1).alias("blocks"))


def against_heads(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b): of the first members of its lists that it may be linked with, each member and the smallest."""
    first = F.col("node") == F.col("head")
    kept = members.select("key", "block", (~first).alias("later"), "node", "n", "kind", "place")
    # the first one of a long list goes to all its blocks
    copies = members.where(first).join(cut(members), "key").withColumn("block", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    dealt = kept.unionByName(copies.select("key", "block", F.lit(False).alias("later"), "node", "n", "kind", "place"))
    sketch = F.expr(f"substring(sketch, 1, {LEAST_BITS // 8} << cast(place >> 9 & 3 as int))")
    dealt = with_pieces(dealt, sketches).withColumn("sketch", sketch)

    def run(frames):
        for f in whole_groups(frames, ["key", "block"]):
            rows, later = Rows(f, percent), f["later"].to_numpy()
            j = np.flatnonzero(later)
            i = np.maximum.accumulate(np.where(later, -1, np.arange(len(f))))[j]
            ok = rows.allowed(i, j)
            found = pd.DataFrame({"member": rows.node[j[ok]], "head": rows.node[i[ok]]})
            yield found.groupby("member", as_index=False)["head"].min()

    found = dealt.repartition("key", "block").sortWithinPartitions("key", "block", "later", "n", "node").mapInPandas(run, "member bigint, head bigint")
    pairs = found.groupBy("member").agg(F.min("head").alias("head"))
    return pairs.select(F.least("member", "head").alias("a"), F.greatest("member", "head").alias("b")).distinct()


def dealt_across(members: DataFrame, block: int) -> DataFrame:
    """Members of lists with the groups (x, y) in which they meet members with other roots.

    A short list is one group. In a list of several blocks the members of the largest root (``side``
    1) stay in their block x; the others (``side`` 2) are dealt by hash into runs y of about ``block``.
    Each run meets each block, and at x < 0 each other run.
    """
    long = cut(members)
    counts = members.join(long, "key").groupBy("key", "root").agg(F.count("*").alias("times"), F.max("blocks").alias("blocks"))
    largest = counts.groupBy("key").agg(F.max_by("root", F.struct("times", "root")).alias("largest"), (F.sum("times") - F.max("times")).alias("others"), F.max("blocks").alias("blocks"))
    largest = largest.withColumn("runs", F.ceil(F.col("others") / block).cast("int")).drop("others")
    known = members.join(largest, "key", "left")
    known = known.withColumn("side", F.when(F.col("blocks").isNull(), 0).when(F.col("root") == F.col("largest"), 1).otherwise(2))
    known = known.withColumn("run", F.when(F.col("side") == 2, F.pmod(F.xxhash64("node"), F.col("runs"))).otherwise(0).cast("int"))
    group = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    zero = F.lit(0)
    stays = F.transform(F.sequence(zero, F.col("runs") - 1), lambda y: group(F.col("block"), y))
    meets = F.transform(F.sequence(zero, (F.col("blocks") - 1).cast("int")), lambda x: group(x, F.col("run")))
    others = F.transform(F.sequence(zero, F.col("runs") - 1), lambda y: group(-F.least(y, F.col("run")) - 1, F.greatest(y, F.col("run"))))
    groups = F.when(F.col("side") == 0, F.array(group(zero, zero))).when(F.col("side") == 1, stays).otherwise(F.concat(meets, others))
    return known.withColumn("group", F.explode(groups)).select("key", "group.x", "group.y", "side", "run", "root", "node", "n", "kind", "place")


class Trees:
    """Components of runs (members of a list with one root) that candidate pairs would join."""

    def __init__(self, runs: int):
        self.parent = np.arange(runs)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return self.parent[i] != self.parent[j]

    def joining(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Places of the pairs of runs that join two trees, in their order; the trees are joined."""
        chosen = []
        for at in np.flatnonzero(self.apart(i, j)).tolist():
            a, b = i[at], j[at]
            while self.parent[a] != a:
                a = self.parent[a]
            while self.parent[b] != b:
                b = self.parent[b]
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                chosen.append(at)
        while (self.parent[self.parent] != self.parent).any():
            self.parent = self.parent[self.parent]
        return np.array(chosen, np.int64)


def across(members: DataFrame, sketches: DataFrame, percent: int, block: int = BLOCK, trees: bool = False) -> DataFrame:
    """Candidate pairs (a, b) of list members with different roots; with ``trees`` only those that join a list's roots into trees.

    ``members`` has only lists with several roots.
    """

    def run(frames):
        for f in whole_groups(frames, ["key", "x", "y"]):
            rows = Rows(f, percent)
            key, x, y, side, run, root = (f[c].to_numpy() for c in ("key", "x", "y", "side", "run", "root"))
            group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))])
            run_of = np.concatenate([[0], np.cumsum((group[1:] != group[:-1]) | (root[1:] != root[:-1]))])
            # rows follow their group and root: partners begin where a row's root ends
            end = np.searchsorted(group, group, side="right")
            beyond = np.searchsorted(run_of, run_of, side="right")
            joined = Trees(len(f))
            out, step, at = [], 0, np.arange(len(f))
            while len(at := at[beyond[at] + step < end[at]]):
                i, j = at, beyond[at] + step
                step += 1
                # a block and a run: pairs of both; two runs: pairs of both, or all if they are one
                meant = (side[i] == 0) | np.where(x[i] >= 0, side[i] != side[j], (-1 - x[i] == y[i]) | (run[i] != run[j]))
                if trees:
                    meant &= joined.apart(run_of[i], run_of[j])
                i, j = i[meant], j[meant]
                ok = np.flatnonzero(rows.allowed(i, j, once=True))
                if trees:
                    ok = ok[joined.joining(run_of[i[ok]], run_of[j[ok]])]
                if len(ok):
                    a, b = rows.node[i[ok]], rows.node[j[ok]]
                    out.append(pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}))
            if out:
                yield pd.concat(out).drop_duplicates()

    dealt = with_pieces(dealt_across(members, block), sketches).repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "root", "n", "node")
    return dealt.mapInPandas(run, "a bigint, b bigint").distinct()


def linked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` whose overlap, counted on the whole sets, reaches the threshold."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = texts_of_sets(needed, docs, sets)

    def run(frames):
        seen: set[int] = set()
        for f in frames:
            out, texts = [], f["text"].tolist()
            for s, text in zip(shingle_sets(texts, width), texts):
                node = int(node_of(s)[0])
                if node not in seen:
                    if len(seen) >= REMEMBER:
                        seen.clear()
                    seen.add(node)
                    out.append((node, text))
            yield pd.DataFrame(out, columns=["node", "text"])

    held = scratch_table(wanted.mapInPandas(run, "node bigint, text string"), "texts")
    # a row repeated with id and text comes once from each task that has it
    repeated = held.groupBy("node").agg(F.count("*").alias("times")).where("times > 1").select("node")
    held = held.join(repeated, "node", "left_anti").unionByName(held.join(repeated, "node", "left_semi").dropDuplicates(["node"]))

    def verify(frames):
        for f in frames:
            keep = []
            for one, two in zip(shingle_sets(f["x"].tolist(), width), shingle_sets(f["y"].tolist(), width)):
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield f.loc[keep, ["a", "b"]]

    one = held.select(F.col("node").alias("a"), F.col("text").alias("x"))
    two = held.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInPandas(verify, "a bigint, b bigint")


def classes(docs: DataFrame, percent: int = 90, width: int = 3, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, name (hash of id and text), n_shingles, root (the component's node), component_id."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType
    sizes = Sizes(percent)
    source = ids_and_texts(docs, id_col, text_col)
    keyed = source.select(F.col("doc_id").cast("string"), F.xxhash64("doc_id", F.xxhash64("text")).alias("name"), "text")
    all_sets = scratch_table(described(keyed, width), "described")
    sets = all_sets.where("n_shingles > 0")

    # counts of small sets by size: at most 2 * MOST_LIGHT rows
    counts = {r["n_shingles"]: r["count"] for r in sets.where(F.col("n_shingles") <= 2 * MOST_LIGHT).groupBy("n_shingles").count().collect()}
    boundary = boundary_by_cost(counts, sizes)

    lists = scratch_table(shared_lists(postings(keyed, width, sizes, boundary), block), "lists")
    light = lists.where((F.col("kind") < 0) & (F.col("head_n") == -F.col("kind")) & (F.col("node") != F.col("head"))).select(F.col("node").alias("a"), F.col("head").alias("b"))
    heavy = lists.where("kind >= 0")
    # only sets that share a list are sketched
    sketches = scratch_table(sketched(texts_of_sets(heavy.select("node").distinct(), keyed, sets), width, percent), "sketches")

    first = scratch_table(against_heads(heavy, sketches, percent), "first-pairs")
    sure = scratch_table(linked(first, keyed, sets, width, percent).union(light).distinct(), "sure")
    tested, roots = first, components(sure)
    for trees in (True, False):
        rooted = heavy.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # lists within one component have nothing left to find
        mixed_lists = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
        # written, since ``across`` reads them four times: the driver would hold as many copies of these joins in one plan
        members = scratch_table(rooted.join(mixed_lists, "key", "left_semi").drop("head", "head_n"), "mixed-lists")
        pairs = across(members, sketches, percent, block, trees)
        pairs = scratch_table(pairs.join(tested, ["a", "b"], "left_anti"), "tree-pairs" if trees else "rest-pairs")
        if pairs.isEmpty():  # the components stay
            continue
        sure = scratch_table(sure.union(linked(pairs, keyed, sets, width, percent)), "sure")
        tested, roots = tested.union(pairs), components(sure)

    label = sets.select("node", F.col("doc_id").cast(kind).alias("id")).groupBy("node").agg(F.min("id").alias("least"))
    label = label.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    label = scratch_table(label, "labels")
    least = label.groupBy("root").agg(F.min("least").alias("component_id"))
    label = label.join(least, "root").select("node", "root", "component_id")
    out = all_sets.withColumn("doc_id", F.col("doc_id").cast(kind)).join(label, "node", "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "name", "n_shingles", "root", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def join(docs: DataFrame, percent: int = 90, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    return classes(docs, percent, width, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the one with the smallest id.

    Null ids come last, equal ids are told apart by a hash of the text, and of rows that agree in
    both one stays. Texts without words all stay. Only rows that may go, or that repeat, shuffle.
    """
    found = scratch_table(classes(docs, percent, width, id_col, text_col).where("n_shingles > 0"), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "name")
    stays = found.groupBy("root").agg(F.min(order).alias("stays")).select("root", F.col("stays.name").alias("stays"))
    names = found.groupBy("name", "root").agg(F.count("*").alias("times"))
    concerned = names.join(stays, "root").withColumn("stay", F.col("name") == F.col("stays")).where("not stay or times > 1").select("name", "stay")
    concerned = scratch_table(concerned, "concerned")
    bits = bits_for(concerned.count())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(id_col), F.xxhash64(text_of(text_col))).alias("name"))
    rows = marked(rows, F.col("name"), bitmap_of(concerned.select(F.col("name").alias("hash")), bits), bits, "maybe")
    looked = rows.where("maybe").join(concerned, "name", "left")
    once = looked.where("stay").dropDuplicates(["name"])
    kept = rows.where("not maybe").select("row").unionByName(looked.where("stay is null").select("row")).unionByName(once.select("row"))
    return kept.select("row.*")
