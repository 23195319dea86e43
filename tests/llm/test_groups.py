"""Dedup, joins and shards against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from ledgermart.llm import bloom, feistel, line_dedup, set_join
from ledgermart.llm.bitmaps import bitmap_of, marked
from ledgermart.llm.components import components
from tests.llm.helpers import awkward, awkward_rows, empty, frame, words

# --- exact dedup ----------------------------------------------------------------


@pytest.mark.parametrize("segments", [bloom.MAX_SEGMENTS, 1])
def test_exact_groups(spark, segments):
    rng = random.Random(1)
    texts = [words(rng, 6) for _ in range(60)]
    rows = [(i, rng.choice(texts) if i % 3 else texts[0]) for i in range(300)] + [(300, None), (301, "")]
    found = {r["doc_id"]: r for r in bloom.dedup(frame(spark, rows).repartition(6), max_segments=segments).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(found) == len(rows)
    for i, t in rows:
        g, r = groups[t or ""], found[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), i == max(g))
        assert r["text_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_a_full_filter_only_costs_shuffles(spark):
    from pyspark.sql import functions as F

    hashes = spark.range(200_000).select(F.xxhash64("id").alias("hash"))
    looked = bloom.looked_up(hashes, bloom.filter_of(hashes, 1), 1)
    assert looked.where("maybe").count() > 100_000
    wide = bloom.segments_for(200_000)
    few = bloom.looked_up(hashes, bloom.filter_of(hashes, wide), wide)
    # 16 bits a row: another row hits each of its two bits with chance 1 - exp(-1/8)
    assert few.where("maybe").count() < 0.02 * 200_000
    assert bloom.looked_up(hashes, bloom.filter_of(hashes, wide), wide, "once").where("not maybe").count() == 0


def test_exact_dedup_awkward_rows(spark):
    found = bloom.dedup(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t in awkward_rows()})
    sizes = Counter(t or "" for _, t in awkward_rows())
    assert sorted(r["group_size"] for r in found) == sorted(sizes[t or ""] for _, t in awkward_rows())
    assert bloom.dedup(empty(spark)).count() == 0


def test_bitmap_lets_no_member_go(spark):
    from pyspark.sql import functions as F

    members = spark.range(0, 5000, 5).select(F.xxhash64("id").alias("hash"))
    found = marked(spark.range(5000), F.xxhash64("id"), bitmap_of(members, 1 << 17), 1 << 17, "hit")
    assert found.where("id % 5 = 0 and not hit").count() == 0
    assert found.where("id % 5 <> 0 and hit").count() < 200


# --- line dedup -----------------------------------------------------------------


def within_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def lines_by_brute_force(rows):
    first = {}
    for doc_id, text in sorted(rows):
        for pos, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\r\f\v"):
                first.setdefault(line, (doc_id, pos))
    near = {a for a in first for b in first if len(a) >= 20 <= len(b) and first[b] < first[a] and within_one(a, b)}
    out = {}
    for doc_id, text in rows:
        kept = [x for pos, x in enumerate((text or "").split("\n")) if x not in first or (first[x] == (doc_id, pos) and x not in near)]
        out[doc_id] = "\n".join(kept) if text else text
    return out


def test_lines_within_one_edit(spark):
    rng = random.Random(8)
    pool = [words(rng, rng.randint(1, 12)) for _ in range(40)] + ["", "ab", "é" * 25, "éa" * 20]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            x = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randint(0, len(x))
                x[at : at + rng.choice([0, 1])] = rng.choice(["", "q", "é"])
            lines.append("".join(x))
        rows.append((i, "\n".join(lines)))
    rows += [(120, "a" * 30), (121, "a" * 31), (122, "a" * 29 + "\n" + "a" * 32), (123, "ab" * 12), (124, "ba" * 12)]
    expected = lines_by_brute_force(rows)
    found = {r["doc_id"]: r for r in line_dedup.dedup(frame(spark, rows).repartition(4)).collect()}
    assert {i: r["text"] for i, r in found.items()} == expected
    for i, text in rows:
        assert found[i]["n_lines"] == (len(text.split("\n")) if text else 0)
        kept = 0 if not expected[i] and found[i]["n_dropped"] == found[i]["n_lines"] else len(expected[i].split("\n")) if text else 0
        assert found[i]["n_lines"] - found[i]["n_dropped"] == kept


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    counts = ("c1", "c2", "c3")
    found = line_dedup.dedup(docs, counts=counts)
    assert found.columns == [*docs.columns, *counts]
    rows = found.collect()
    assert len(rows) == len(awkward_rows())
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r["text"])
    text = dict(awkward_rows())[1]
    assert by_id[1] == [text] and by_id[5] == ["", ""] and by_id[2] == [None] and by_id[3] == [""]
    assert by_id[7] == [" \n\t "] and by_id[4] == [dict(awkward_rows())[4]]
    assert line_dedup.dedup(empty(spark)).count() == 0


# --- n-gram join ----------------------------------------------------------------


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components_by_brute_force(rows, percent, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(x)] = top(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[top(x)] = min(least.get(top(x), i), i)
    return {i: (len(s), least[top(x)]) for x, (i, s) in enumerate(sets)}


def near_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(14):
        base = words(rng, rng.choice([2, 4, 12, 14, 22, 30, 60, 150])).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = rng.choice([[], ["zz"], [words(rng, 1)]])
            rows.append((len(rows), (" " if rng.random() < 0.9 else "\n").join(copy).upper() if rng.random() < 0.1 else " ".join(copy)))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \t")]


@pytest.mark.parametrize(("percent", "width", "block"), [(90, 3, 2048), (80, 5, 3), (60, 1, 4)])
def test_components_of_links(spark, percent, width, block):
    rows = near_rows(percent)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in set_join.classes(frame(spark, rows).repartition(3), percent, width, block=block).collect()}
    assert found == components_by_brute_force(rows, percent, width)


def test_a_cluster_in_several_blocks(spark):
    """Lists of several blocks with one large component, a second one and single documents."""
    rng = random.Random(5)
    base = words(rng, 80).split()
    other = base[:30] + words(rng, 50).split()
    rows = []
    for i in range(70):
        copy = list(base if i % 3 else other)
        for _ in range(rng.choice([0, 1, 2])):
            copy[rng.randrange(len(copy))] = words(rng, 1)
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(base[: 40 + i] + words(rng, 40 - i).split())) for i in range(0, 40, 4)]
    for block in (3, 9):
        found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in set_join.classes(frame(spark, rows).repartition(3), 80, 2, block=block).collect()}
        assert found == components_by_brute_force(rows, 80, 2)


def test_light_and_heavy_sets_meet():
    """Every linked pair has a list in common, whichever side of the boundary its sets lie on."""
    rng = np.random.default_rng(3)
    for percent in (70, 80, 90):
        sizes = set_join.Sizes(percent)
        for boundary in (1, 10, 14):
            for _ in range(150):
                a = np.unique(rng.integers(0, 2**63, rng.integers(1, 30)).astype(np.uint64))
                b = np.unique(np.concatenate([a[rng.integers(0, 3) :], rng.integers(0, 2**63, rng.integers(0, 3)).astype(np.uint64)]))
                if not len(b):
                    continue
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    one, two = (set_join.postings_of(s, sizes, boundary)[0] for s in (a, b))
                    assert len(np.intersect1d(one, two)), (percent, boundary, len(a), len(b))


def test_sizes_of_partners():
    for percent in (60, 80, 90):
        sizes = set_join.Sizes(percent)
        for a in range(1, 200):
            for b in range(1, 200):
                possible = 100 * min(a, b) >= percent * max(a, b)
                assert possible == (b in sizes.partners(a))
                if possible:
                    assert abs(sizes.class_of(a) - sizes.class_of(b)) <= 1
                    o = sizes.overlap(a, b)
                    assert 100 * o >= percent * (a + b - o) and 100 * (o - 1) < percent * (a + b - o + 1)
                    assert a + b - 2 * o < sizes.parts(max(sizes.class_of(a), sizes.class_of(b)))


def rows_in_lists(a, b, sizes, boundary=1):
    """The lists that two sets share, as a frame of their members."""
    frames = []
    for node, s in ((1, a), (2, b)):
        key, kind, place = set_join.postings_of(s, sizes, boundary)
        own = sizes.class_of(len(s))
        slices = {g: set_join.slices_of(s, sizes, g) for g in (own, own + 1)}
        heavy = kind >= 0
        f = pd.DataFrame({"key": key[heavy].view(np.int64), "node": node, "n": len(s), "kind": kind[heavy], "place": place[heavy]})
        width = f["place"] & 511
        f["sketch"] = [slices[g][(x >> 20) * w : ((x >> 20) + 1) * w] for g, x, w in zip(f["kind"], f["place"], width)]
        assert f["sketch"].map(len).equals(width)
        frames.append(f)
    both = frames[0].merge(frames[1], on="key")
    one = both[[c for c in both if c.endswith("_x") or c == "key"]].rename(columns=lambda c: c.removesuffix("_x"))
    two = both[[c for c in both if c.endswith("_y") or c == "key"]].rename(columns=lambda c: c.removesuffix("_y"))
    return pd.concat([one, two], ignore_index=True), len(both)


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("n", [12, 45, 200, 1500, 6000])
def test_linked_sets_meet_in_a_slice(percent, n):
    """Every linked pair is sent on from a common list, and from two of a slice at most."""
    rng, sizes = np.random.default_rng(n + percent), set_join.Sizes(percent)
    for _ in range(60 if n < 1000 else 12):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        most = 2 * len(a) * (100 - percent) // (100 + percent)
        gone, new = (rng.integers(0, most + 1) for _ in range(2))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, new).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        f, m = rows_in_lists(a, b, sizes)
        if 100 * both < percent * (len(a) + len(b) - both):
            continue
        rows = set_join.Rows(f, percent)
        sent = rows.allowed(np.arange(m), np.arange(m) + m, once=True)
        assert sent.any(), (len(a), len(b), both)
        slices = Counter(rows.slice[:m][sent].tolist())
        assert max(slices.values()) <= 2 and (rows.allowed(np.arange(m), np.arange(m) + m) >= sent).all()


def test_sketches_drop_long_sets_that_share_half():
    rng, sizes = np.random.default_rng(6), set_join.Sizes(80)
    a, b = (rng.integers(0, 2**63, 9000).astype(np.uint64) for _ in range(2))
    a, b = np.unique(a), np.unique(np.concatenate([a[:4500], b[:4500]]))
    f, m = rows_in_lists(a, b, sizes)
    assert m > 50  # they agree on parts by chance
    assert not set_join.Rows(f, 80).allowed(np.arange(m), np.arange(m) + m).any()


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for percent in (60, 90):
        sizes = set_join.Sizes(percent)
        for n in (300, 3000):
            for _ in range(30):
                a, b = (np.unique(rng.integers(0, n + n // 3, n).astype(np.uint64)) for _ in range(2))
                g = max(sizes.class_of(len(a)), sizes.class_of(len(b)))
                k, size, stride = sizes.slices(g), sizes.bits(g) // 8, sizes.stride(g)
                one, two = (np.frombuffer(set_join.slices_of(s, sizes, g), np.uint8).reshape(k, stride)[:, :size] for s in (a, b))
                found = np.bitwise_count(one ^ two).sum(axis=1)
                part = lambda s: (set_join.mixed(s ^ set_join.MIX) >> np.uint64(33)) % np.uint64(sizes.parts(g)) % np.uint64(k)
                differing = np.setxor1d(a, b)
                assert (found <= np.bincount(part(differing).astype(int), minlength=k)).all() and 0 < found.sum()


def test_boundary_follows_the_cost():
    sizes = set_join.Sizes(90)
    assert set_join.boundary_by_cost({}, sizes) == 1
    assert 9 <= set_join.boundary_by_cost({9: 100, 300: 5}, sizes) <= 20


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 60)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_plans_of_the_join_have_few_scans(spark, monkeypatch):
    """Every scan of a plan costs the driver a few MB at once, whatever it reads."""
    import importlib

    scans, write = {}, set_join.scratch_table

    def counted(df, name):
        scans[name] = max(scans.get(name, 0), df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return write(df, name)

    for module in ("set_join", "components"):
        monkeypatch.setattr(importlib.import_module(f"ledgermart.llm.{module}"), "scratch_table", counted)
    rng = random.Random(4)
    text = words(rng, 60)
    found = set_join.join(frame(spark, [(1, text), (2, text + " x"), (3, words(rng, 60))]), 80, 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 1, 3: 3}
    assert {"tree-pairs", "rest-pairs", "links"} <= set(scans)
    assert max(scans.values()) <= 10, scans


def test_join_of_awkward_rows(spark):
    found = set_join.join(awkward(spark)).collect()
    assert len(found) == len(awkward_rows())
    by_id = defaultdict(set)
    for r in found:
        by_id[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by_id[1] == by_id[5] == by_id[8] == {(48, 1)} and by_id[3] == {(0, 3)} and by_id[2**60 + 1] == {(1, 2**60 + 1)}
    assert {c for _, c in by_id[None]} == {None}
    assert set_join.join(empty(spark)).count() == 0
    docs = awkward(spark)
    kept = set_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 3, 4, None, None, 6, 7, 2**60 + 1, 9]))


# --- shards ---------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 100, 997])
def test_permutation_is_one_to_one(spark, n):
    from pyspark.sql import functions as F

    places = [r[0] for r in spark.range(n).select(feistel.permuted(F.col("id"), F.lit(n).cast("bigint"), 5)).collect()]
    assert sorted(places) == list(range(n))
    if n > 50:
        assert places != sorted(places) and abs(np.corrcoef(places, range(n))[0, 1]) < 0.25


def test_shards_are_even_and_gapless(spark):
    import zlib

    rows = [(i, f"text {i % 50}" * (i % 9)) for i in range(500)] + [(3, "text 3" * 3)] * 40 + [(None, None)] * 30
    a = feistel.shard(frame(spark, rows).repartition(7)).collect()
    b = feistel.shard(frame(spark, rows).coalesce(1)).collect()
    key = lambda r: (r["shard"], r["slot"])
    assert sorted(a, key=key) == sorted(b, key=key)
    by_shard = defaultdict(list)
    for r in a:
        by_shard[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert set(by_shard) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    counts = [len(s) for s in by_shard.values()]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in a)
    assert got == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)


def test_shards_of_awkward_rows(spark):
    found = feistel.shard(awkward(spark), shards=4).collect()
    assert len(found) == len(awkward_rows()) and len({(r["shard"], r["slot"]) for r in found}) == len(found)
    assert feistel.shard(empty(spark)).count() == 0


def test_numbers_of_a_repeated_row_come_in_chunks(spark):
    placed = spark.createDataFrame([(None, 8, 0, 1000, 5, 1013), (1, 9, 1, 1, 0, 1013), (2, 9, 2, 7, 1005, 1013), (3, 9, 3, 4, 1, 1013), (4, 9, 4, 1, 1012, 1013)], "doc_id bigint, size bigint, text_crc32 bigint, times bigint, first bigint, total bigint")
    found = feistel.each_number(placed, chunk=7)
    rows = found.collect()
    assert sorted(r["number"] for r in rows) == list(range(1013))
    assert all(5 <= r["number"] < 1005 for r in rows if r["doc_id"] is None) and sum(r["doc_id"] is None for r in rows) == 1000
