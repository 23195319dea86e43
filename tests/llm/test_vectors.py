"""Lexical search, cover trees and whitening against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgermart.llm import ball_tree, cover_tree, whitening
from tests.llm.helpers import awkward, awkward_rows, empty, frame, words

# --- lexical search -------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows, items, k=10):
    """item row -> [(doc_id, score)], by the formula."""
    docs = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    held = [(i, c) for i, c in docs if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for item, text in items:
        terms, found = set(TERM.findall((text or "").translate(LOWER))), []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((i, score))
        found.sort(key=lambda r: (-r[1], r[0] is None, r[0]))
        out += [(item, rank + 1, i, s) for rank, (i, s) in enumerate(found[:k])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize(("tree", "leaf", "vocabulary"), [(4096, 64, 8192), (40, 4, 8192), (64, 2, 30)])
def test_search_finds_what_the_formula_ranks(spark, monkeypatch, tree, leaf, vocabulary):
    monkeypatch.setattr(ball_tree, "TREE", tree)
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    monkeypatch.setattr(ball_tree, "VOCABULARY", vocabulary)
    rng = random.Random(11)
    lexicon = words(rng, 120).split()
    texts = [" ".join(rng.choices(lexicon, weights=range(120, 0, -1), k=rng.randint(1, 60))) for _ in range(150)]
    # a third of all rows are copies, so scores tie beyond the tenth rank
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(2000 + i, texts[0]) for i in range(80)] + [(5, None), (6, "—!?"), (7, "Ünïcode ÜNÏCODE x9")]
    items = [(j, " ".join(rng.sample(lexicon, 9))) for j in range(12)] + [(50, texts[0].upper()), (51, None), (52, "nosuchword"), (53, "ünïcode"), (54, lexicon[0])]
    found = ball_tree.search(frame(spark, rows).repartition(5), items_of(spark, items))
    assert sorted([tuple(r) for r in found.collect()], key=str) == ranked(rows, items)


def test_search_prunes_and_bounds_hold():
    rng = np.random.default_rng(5)
    rows = []
    for group in range(64):  # groups of near equal documents, each with its own terms
        base = rng.choice(20, 6, replace=False) + 20 * group
        rows += [{int(t): int(rng.integers(900, 1000)) for t in base} for _ in range(64)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    tree = ball_tree.BallTree(starts, np.array([t for r in rows for t in r]), np.array([v for r in rows for v in r.values()]), 1280)
    visited = []
    for group in range(64):
        terms = np.arange(20 * group, 20 * group + 20)
        asked = np.zeros(1280, np.int64)
        asked[terms] = 1
        bounds = tree.bounds(terms)
        for node in range(len(tree.lo)):
            assert bounds[node] >= tree.scores(node, asked).max()
        best = ball_tree.Best(10)
        visited.append(ball_tree.descend(tree, terms, asked, best, [(False, i, str(i)) for i in range(len(rows))]))
        scores = [sum(v for t, v in r.items() if t in set(terms.tolist())) for r in rows]
        assert [-s for s, _ in best.rows] == sorted(scores, reverse=True)[:10]
    assert np.median(visited) <= 4  # of 64 leaves


def test_search_awkward_rows(spark):
    items = [(1, "one a b"), (None, "é中😀 x"), (None, "é中😀 x"), (3, words(random.Random(3), 50))]
    found = ball_tree.search(awkward(spark), items_of(spark, items))
    assert sorted([tuple(r) for r in found.collect()], key=str) == ranked(awkward_rows(), items)
    assert ball_tree.search(empty(spark), items_of(spark, items)).count() == 0
    assert ball_tree.search(awkward(spark), items_of(spark, [])).columns == ["item_id", "rank", "doc_id", "score"]


# --- near duplicates ------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()), T.StructField("x", T.StringType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "n", None) for i, v in rows], VECTORS)


def usable(v):
    return bool(v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v))


def linked(a, b, threshold):
    if len(a) != len(b):
        return False
    p, q = [Fraction(float(x)) for x in a], [Fraction(float(x)) for x in b]
    dot = sum(x * y for x, y in zip(p, q))
    return dot >= 0 and dot**2 >= Fraction(str(threshold)) ** 2 * sum(x * x for x in p) * sum(y * y for y in q)


def near(rows, threshold=0.9):
    n = len(rows)
    links = [[j for j in range(n) if j != i and usable(rows[i][1]) and usable(rows[j][1]) and linked(rows[i][1], rows[j][1], threshold)] for i in range(n)]
    part = list(range(n))
    while True:
        now = [min([part[i], *[part[j] for j in links[i]]]) for i in range(n)]
        if now == part:
            break
        part = now
    least = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            least[part[i]] = min(vec_id, least.get(part[i], vec_id))
    return sorted([(rows[i][0], len(links[i]), least.get(part[i]), rows[i][0] == least.get(part[i])) for i in range(n)], key=str)


def clustered(rng, n, dim, centres, spread):
    c = rng.standard_normal((centres, dim))
    return (c[rng.integers(0, centres, n)] + spread * rng.standard_normal((n, dim))).tolist()


@pytest.mark.parametrize(("dim", "centres", "spread", "threshold"), [(6, 9, 0.2, 0.9), (3, 90, 0.1, 0.99), (16, 4, 0.01, 0.9), (2, 40, 0.3, 0.7)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, dim, centres, spread, threshold):
    monkeypatch.setattr(cover_tree, "LEAST_TILE", 16)
    monkeypatch.setattr(cover_tree, "BLOCK", 11)
    rng = np.random.default_rng(dim)
    found = clustered(rng, 130, dim, centres, spread)
    rows = [(500 - i, v) for i, v in enumerate(found)] + [(600 + i, found[0]) for i in range(60)] + [(700, [3 * c for c in found[1]])]
    got = cover_tree.near_dedup(vectors(spark, rows).repartition(4), threshold)
    assert sorted([tuple(r) for r in got.collect()], key=str) == near(rows, threshold)
    # pairs between different vectors, named by the smallest id
    name = {}
    for i, v in rows:
        name[tuple(v)] = min(i, name.get(tuple(v), i))
    want = {tuple(sorted((name[p], name[q]))) for p in name for q in name if p < q and linked(p, q, threshold)}
    pairs = [(r["a"], r["b"]) for r in cover_tree.pairs(vectors(spark, rows), threshold).collect()]
    assert len(pairs) == len(want) and set(pairs) == want


def test_near_duplicates_awkward_rows(spark):
    at = [1.0] * 9 + [1.0] + [0.0] * 9
    beside = [1.0] * 9 + [0.0] + [1.0] + [0.0] * 8  # a cosine of 9 / 10 exactly
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (8, [2.0, 4.0])]
    rows += [(None, [1.0, 2.0, 0.0]), (None, [1.0, 2.0, 0.0]), (None, [0.0, 0.0, 1.0]), (9, [1e300, 1e300]), (10, [1e-310, 1e-310]), (11, at), (12, beside), (13, [-1.0, -2.0]), (14, [5.0]), (14, [-5.0])]
    got = cover_tree.near_dedup(vectors(spark, rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = sorted([tuple(r) for r in got.collect()], key=str)
    want = sorted([(a, b, c, a == c) for a, b, c, _ in near(rows)], key=str)
    assert found == want
    assert cover_tree.near_dedup(vectors(spark, [])).count() == 0 and cover_tree.pairs(vectors(spark, [])).count() == 0
    assert [tuple(r) for r in cover_tree.near_dedup(vectors(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_cover_tree_is_nested_and_covers():
    rng = np.random.default_rng(2)
    raw = cover_tree.plain(clustered(rng, 300, 5, 12, 0.2))
    tree = cover_tree.CoverTree.grown(np.arange(300), np.ones(300, np.int64), raw)
    d = cover_tree.apart(tree.unit, tree.unit)
    for level, radius in enumerate(cover_tree.RADII):
        k = tree.counts[level]
        off = d[:k, :k] + 9 * np.eye(k)
        assert off.min() > radius or k == 1  # separated
        assert d[:, :k].min(axis=1).max() <= radius + 1e-9  # covered
        held = d[np.arange(300), tree.above[level]]
        assert (held <= tree.radii[level][tree.above[level]] + 1e-6).all()
    assert tree.counts[-1] == 300 and sorted(tree.nodes) == list(range(300))
    again = cover_tree.packed(3, tree)
    row = type("Row", (), dict(zip([c.split()[0] for c in cover_tree.TREE.split(", ")], again)))
    assert (cover_tree.unpacked(row).raw == tree.raw).all()


# --- whitening ------------------------------------------------------------------


def spectra(kind, n):
    return {"spread": np.linspace(1, 3, n), "equal": np.repeat(2.0, n), "two": np.r_[np.repeat(4.0, n // 2), np.repeat(1.0, n - n // 2)], "steep": 10.0 ** -np.arange(n), "signed": np.linspace(-2, 2, n), "singular": np.r_[1.0, np.zeros(n - 1)]}[kind]


@pytest.mark.parametrize("n", [1, 2, 7, 40])
@pytest.mark.parametrize("kind", ["spread", "equal", "two", "steep", "signed", "singular"])
def test_divide_and_conquer_finds_eigenvectors(kind, n):
    q, _ = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
    a = (q * spectra(kind, n)) @ q.T
    a = (a + a.T) / 2
    for leading in (min(n, 4), None):
        values, v = whitening.spectrum(a, leading)
        size = np.linalg.norm(a)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][: len(values)]).max() <= 1e-13 * size
        assert np.linalg.norm(a @ v - v * values) <= 1e-13 * size
        assert np.abs(v.T @ v - np.eye(v.shape[1])).max() <= 1e-13


def whitened(rows, leading=4):
    longest = max((len(v) for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)), default=0)
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and len(v) == longest and longest and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, total = len(fit), [sum(c) for c in fit.T.tolist()]
    centred = fit.astype(float) - np.array([s / n for s in total])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, total, e[::-1][:leading], v[:, ::-1][:, :leading], e.sum()


def test_whitening_equals_an_eigenvalue_routine(spark):
    rng = np.random.default_rng(13)
    found = (rng.standard_normal((400, 9)) * np.linspace(1, 4, 9)).tolist()
    rows = [(i, v) for i, v in enumerate(found)] + [(1000 + i, found[0]) for i in range(150)] + [(2000, None), (2001, [None, *found[0][1:]]), (2002, [math.nan, *found[0][1:]]), (2003, found[0][:4]), (None, found[1]), (0, found[2]), (2004, [])]
    kept, n, total, e, v, trace = whitened(rows)
    got = whitening.whiten(vectors(spark, rows).repartition(5)).collect()
    assert len(got) == 4 * len(kept)
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    want = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, total))
        y = (np.array(x, float) - np.array(total) / n) @ v / np.sqrt(e)
        for c in range(4):
            want.setdefault((i, c + 1), []).append((deviation, abs(y[c])))
    sign = {}
    for r in got:
        assert any(d == r["deviation"] and abs(abs(r["whitened"]) - y) < 1e-9 for d, y in want[r["vec_id"], r["component"]])
        assert abs(r["explained"] - e[r["component"] - 1] / trace) < 1e-12
        x = next(x for i, x in kept if i == r["vec_id"])
        if r["vec_id"] not in (0, None):
            y = ((np.array(x, float) - np.array(total) / n) @ v / np.sqrt(e))[r["component"] - 1]
            if abs(y) > 1e-6:
                sign.setdefault(r["component"], set()).add(np.sign(y) == np.sign(r["whitened"]))
    assert all(len(s) == 1 for s in sign.values())


def test_whitening_awkward_rows(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    none = whitening.whiten(vectors(spark, []))
    assert none.columns == names and none.count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, []), (3, [None])])).count() == 0
    # one distinct vector: no component varies
    got = whitening.whiten(vectors(spark, [(1, [-0.0, 0.3]), (2, [0.0, 0.3])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got] == [(1, 0, 0.0, 0.0, 0.0)] * 4
    # one direction varies; the second component is flat
    got = whitening.whiten(vectors(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])])).collect()
    first = {r["vec_id"]: r for r in got if r["component"] == 1}
    assert first[2]["whitened"] == pytest.approx(0) and abs(first[1]["whitened"]) == pytest.approx(math.sqrt(1.5)) and first[1]["explained"] == pytest.approx(1)
    assert {r["whitened"] for r in got if r["component"] == 2} == {0.0}
    assert first[1]["deviation"] == 2 * (3 * 256) ** 2
    # beyond 64 bits: the deviation is null, the rest stays
    huge = whitening.whiten(vectors(spark, [(1, [1e200, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])])).collect()
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge)
