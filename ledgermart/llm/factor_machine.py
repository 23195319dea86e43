"""Operator 4: a factorisation machine that scores the quality of whole texts.

Features are hashed words (logarithm of their count, scaled to unit length), structure statistics
(shares of characters by kind, repetition of words and lines, lengths), each as a standardised
value and as one of the sample's quantile bins, and the text's length as metadata. The machine adds
a weight per feature and, for each pair of features, the product of two short vectors; all pairs
together cost linear time, since the sum over pairs is half of (squared sum - sum of squares)
for each of the vectors' coordinates.

It is fitted in numpy on at most ``SAMPLE`` labelled rows (a documented bound, chosen by a hash of
the id; each brings at most ``WORDS`` + ``len(STATS)`` numbers to the driver). Scoring is one map
over all texts, with the weights (a few hundred KB, fixed size) sent along.

Edge cases: null and empty texts have zero statistics and no words and get a score from those;
rows without label, or with a null label, don't train; a label repeated for one id counts once,
the largest; without any label every score is 0.5; a null id counts as the empty id; repeated rows
give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import GenerationCache, held, small_batches, text_of

WORDS = 4096
#: At most so many labelled rows are fitted.
SAMPLE = 8000
#: How a labelled row's numbers travel to the driver.
PACKED = {"slots": "<u2", "counts": "<i4", "stats": "<f8"}
BINS = 12
RANK = 8
STATS = (
    "length", "words", "word_length", "upper", "digit", "space", "comma_stop", "symbol", "high_byte", "distinct_words",
    "repeated_next", "top_word", "lines", "distinct_lines", "line_length", "distinct_hashes", "longest_run", "letter_ending",
)

_KIND = np.full(256, 4)  # by byte: 0 upper, 1 digit, 2 white space, 3 comma or full stop, 4 symbol, 5 high byte, 6 lower
_KIND[65:91], _KIND[48:58], _KIND[[9, 10, 11, 12, 13, 32]], _KIND[[44, 46]], _KIND[128:], _KIND[97:123] = 0, 1, 2, 3, 5, 6


def word_slot(word: str) -> int:
    return zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORDS


def featurizer():
    """A function from a text to (slots of its words, their counts, statistics)."""
    memo = GenerationCache(word_slot, 200_000)

    def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = text.split()
        n = len(words)
        slots = np.fromiter([memo[w] if len(w) < 64 else word_slot(w) for w in words], np.int64, n)
        counts = np.bincount(slots, minlength=WORDS)
        present = np.flatnonzero(counts)
        counts = counts[present]
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        kinds = np.bincount(_KIND, weights=np.bincount(raw, minlength=256), minlength=7) / max(1, len(raw))
        lines = text.split("\n")
        change = np.flatnonzero(np.diff(slots)) if n else slots
        runs = np.diff(np.concatenate([[-1], change, [n - 1]])) if n else np.zeros(1)
        stats = [
            np.log1p(len(text)), np.log1p(n), len(text) / max(1, n), kinds[0], kinds[1], kinds[2], kinds[3], kinds[4], kinds[5],
            len(set(words)) / max(1, n), 1 - len(change) / max(1, n - 1) if n > 1 else 0.0, counts.max() / n if n else 0.0,
            np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)), len(present) / max(1, min(n, WORDS)),
            np.log1p(runs.max()), sum(w[-1].isalpha() for w in words) / max(1, n),
        ]
        return present, counts, np.array(stats)

    return features


@dataclass
class Machine:
    """Weights of the linear part and short vectors of the pairs, by feature."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    edges: np.ndarray  # by statistic: BINS - 1 quantiles

    def sparse(self, found) -> tuple[np.ndarray, np.ndarray]:
        """Columns and values of the features of one text."""
        present, counts, stats = found
        value = np.log1p(counts)
        value = value / max(1e-9, np.sqrt((value * value).sum()))
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4) / 2
        at = np.arange(len(STATS))
        bins = (stats[:, None] > self.edges).sum(axis=1)
        columns = np.concatenate([present, WORDS + at, WORDS + len(STATS) + at * BINS + bins])
        return columns, np.concatenate([value, scaled, np.ones(len(STATS))])

    def scores(self, rows: list) -> np.ndarray:
        """Sum-of-squares identity over the rows' features, all rows at once."""
        parts = [self.sparse(r) for r in rows]
        starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in parts])[:-1]])
        columns, x = np.concatenate([c for c, _ in parts]), np.concatenate([v for _, v in parts])
        products = self.vectors[columns] * x[:, None]
        sums = np.add.reduceat(products, starts)
        squares = np.add.reduceat((products * products).sum(axis=1), starts)
        linear = np.add.reduceat(self.weights[columns] * x, starts)
        z = self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list, labels: np.ndarray, epochs: int = 12, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Adam on the logistic loss, in batches made dense one at a time."""
    width = WORDS + len(STATS) * (1 + BINS)
    rng = np.random.default_rng(seed)
    if not len(rows):
        none = np.zeros(len(STATS))
        return Machine(0.0, np.zeros(width), np.zeros((width, RANK)), none, none + 1, np.zeros((len(STATS), BINS - 1)))
    stats = np.stack([r[2] for r in rows])
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    spread = np.maximum(stats.std(axis=0), 1e-6)
    m = Machine(0.0, np.zeros(width), rng.normal(0, 0.02, (width, RANK)), stats.mean(axis=0), spread, edges)
    # one array for all rows: small ones by the thousand stay with the driver's process for good
    at = np.cumsum([0] + [len(r[0]) + 2 * len(STATS) for r in rows])
    columns, values = np.empty(at[-1], np.uint16), np.empty(at[-1])
    for r, lo, hi in zip(rows, at, at[1:]):
        columns[lo:hi], values[lo:hi] = m.sparse(r)
    theta = np.concatenate([m.weights[:, None], m.vectors], axis=1)
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    bias = 0.0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 256):
            take = order[lo : lo + 256]
            x = np.zeros((len(take), width))
            for i, j in enumerate(take):
                x[i, columns[at[j] : at[j + 1]]] = values[at[j] : at[j + 1]]
            w, v, squared = theta[:, 0], theta[:, 1:], x * x
            s = x @ v
            z = bias + x @ w + 0.5 * ((s * s).sum(axis=1) - squared @ (v * v).sum(axis=1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[take]) / len(take)
            grad = np.concatenate([(x.T @ g)[:, None], x.T @ (g[:, None] * s) - v * (squared.T @ g)[:, None]], axis=1) + decay * theta
            step += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad * grad - second)
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            bias -= rate * 10 * g.sum()
    m.bias, m.weights, m.vectors = float(bias), theta[:, 0].copy(), theta[:, 1:].copy()
    return m


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Machine:
    """Fit on at most ``sample`` labelled documents outside fold 0."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    chosen = known.groupBy("doc_id").agg(F.max(target).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = chosen.withColumnRenamed("doc_id", "label_id")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # at most ``sample`` rows of two numbers
    labelled = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("label_id", "text", "label")

    def run(frames):
        features = held("features", featurizer)
        for f in frames:
            rows = [features(t) for t in f["text"]]
            packed = {name: [r[k].astype(kind).tobytes() for r in rows] for k, (name, kind) in enumerate(PACKED.items())}
            yield pd.DataFrame({"label_id": f["label_id"].astype(str), "label": f["label"].astype(float), **packed})

    # an id that repeats in the documents brings one row; its numbers travel packed
    packed_rows = labelled.dropDuplicates(["label_id"]).mapInPandas(run, "label_id string, label double, slots binary, counts binary, stats binary")
    sample_rows = packed_rows.toPandas().sort_values("label_id")
    rows = [tuple(np.frombuffer(b, kind) for b, kind in zip(r, PACKED.values())) for r in zip(*(sample_rows[c] for c in PACKED))]
    return fit(rows, sample_rows["label"].to_numpy())


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3, text_col: str = "text", score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """All columns of ``docs``, with the score and whether it reaches ``threshold``. One map, no shuffle."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: pd.Series) -> pd.Series:
        features = held("features", featurizer)
        return pd.Series(sent.value.scores([features(t) for t in batches])) if len(batches) else pd.Series([], dtype=float)

    scored = F.pandas_udf(run, "double")
    return docs.withColumn(score_col, scored(text_of(text_col))).withColumn(predicted_col, (F.col(score_col) >= threshold).cast("int"))
