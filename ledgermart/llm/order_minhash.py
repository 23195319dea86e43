"""Operator 1: Order MinHash fingerprints, sensitive to edit distance.

Every k-mer of a text (``k`` code points) is numbered by how often it occurred before. Each of
``m`` hash functions ranks these numbered k-mers; the ``ell`` smallest are taken in the order in
which they stand in the text, and the tuple of them is hashed. Two texts agree in a tuple only if
the same k-mers are smallest and stand in the same order, so moved text counts as different.
The likeness of two fingerprints is the share of equal tuples to the power 1 / ell: about the
share of numbered k-mers that the texts have in common order.

``edited_fingerprints`` pairs each document with the next by ascending id in one shuffle of the
texts: ids alone give range bounds and the first id of each range; the document there also goes to
the range before, where the last document needs it. What reaches the driver is one id per range.

Edge cases: null and empty texts have no k-mers and the fingerprint of nothing; a text shorter
than ``k`` is one k-mer; texts with fewer than ``ell`` k-mers use what they have. Null ids come
first. Rows that repeat an id follow each other by a hash of their text. With one row the next
document is the document itself. An empty table gives an empty table. Other columns are ignored.
Ids are numbers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import ids_and_texts, map_texts, small_batches

#: Columns of a block of k-mers, so that the table of all hash functions stays in the cache.
BLOCK = 4096
BITS = 24
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A full-avalanche mix of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


class OrderMinHash:
    def __init__(self, k: int = 8, ell: int = 2, m: int = 64, seed: int = 1):
        if not (k > 0 and ell > 0 and m > 0):
            raise ValueError("k, ell and m are positive")
        self.k, self.ell, self.m = k, ell, m
        words = _mixed(np.arange(1, 2 * m + 1, dtype=np.uint64) * MIX + np.uint64(seed))
        self.salts = words[:m].astype(np.uint32)[:, None]
        self.factors = (words[m:].astype(np.uint32) | np.uint32(1))[:, None]

    def numbered(self, text: str) -> np.ndarray:
        """A 64-bit hash of each k-mer and its occurrence number, in the order of the text."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(points) - self.k + 1
        if not len(points):
            return np.zeros(0, np.uint64)
        base = np.zeros(max(n, 1), np.uint64)
        for i in range(self.k):
            base *= MIX
            if n > 0:
                base += points[i : i + n]
            elif i < len(points):
                base += np.uint64(points[i]) + np.uint64(1)
        base = _mixed(base)
        # equal k-mers side by side and in text order: hash in the high bits, place in the low ones
        n = len(base)
        low = np.uint64(max(1, n.bit_length()))
        order = np.sort((base >> low) << low | np.arange(n, dtype=np.uint64))
        place = order & ((np.uint64(1) << low) - np.uint64(1))
        same = np.zeros(n, bool)
        same[1:] = (order[1:] >> low) == (order[:-1] >> low)
        if same.any():
            at = np.arange(n)
            starts = np.maximum.accumulate(np.where(same, 0, at))
            seen = np.zeros(n, np.uint64)
            seen[place] = (at - starts).astype(np.uint64)
            base = np.where(seen > 0, _mixed(base + seen * MIX), base)
        return base

    def tuples(self, text: str) -> np.ndarray:
        """``m`` tuple hashes of ``BITS`` bits."""
        kmers = self.numbered(text)
        n, ell, rows = len(kmers), min(self.ell, len(kmers)), np.arange(self.m)
        if not n:
            return np.zeros(self.m, np.uint64)
        short = kmers.astype(np.uint32)
        values, places = [], []
        for at in range(0, n, BLOCK):
            v = (short[None, at : at + BLOCK] ^ self.salts) * self.factors
            for _ in range(min(ell, v.shape[1])):
                p = v.argmin(axis=1)
                values.append(v[rows, p].copy())
                places.append(p + at)
                v[rows, p] = 0xFFFFFFFF
        places = np.stack(places, axis=1)
        if places.shape[1] > ell:
            least = np.argsort(np.stack(values, axis=1), axis=1, kind="stable")[:, :ell]
            places = np.take_along_axis(places, least, axis=1)
        places.sort(axis=1)
        out = np.full(self.m, np.uint64(ell))
        for j in range(ell):
            out = _mixed(out * MIX + kmers[places[:, j]])
        return out & np.uint64((1 << BITS) - 1)

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        return float(np.mean(a == b)) ** (1 / self.ell)


def as_string(tuples: np.ndarray) -> str:
    return "".join([f"{x:06x}" for x in tuples.tolist()])


def fingerprints(docs: DataFrame, k: int = 8, ell: int = 2, m: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars and fingerprint. One map, no shuffle."""

    def make():
        sketch = OrderMinHash(k, ell, m)
        return lambda text: (len(text), as_string(sketch.tuples(text)))

    return map_texts(ids_and_texts(docs, id_col, text_col), "n_chars bigint, fingerprint string", make)


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) rows with range and ``tail``: a copy of the next range's first document.

    Ranges hold about equal numbers of rows. Rows of one id are never parted.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.select(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))

    def ranged(df: DataFrame) -> DataFrame:
        # a binary search among the cuts inside the JVM; null ids come first
        from pyspark.ml.feature import Bucketizer

        if not cuts:
            return df.withColumn("range", F.lit(0))
        splits = [float("-inf"), *sorted({float(c) for c in cuts}), float("inf")]
        found = Bucketizer(splits=splits, inputCol="at", outputCol="found", handleInvalid="keep").transform(df.withColumn("at", F.col("doc_id").cast("double")))
        return found.withColumn("range", F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("found").cast("int"))).drop("at", "found")

    heads = sorted((r["range"], r["head"]) for r in ranged(ids).groupBy("range").agg(F.min("doc_id").alias("head")).collect())
    before = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    small = spark.createDataFrame(before, f"head {kind}, also int")
    own = F.struct(F.col("range"), F.lit(False).alias("tail"))
    copy = F.struct(F.col("also").alias("range"), F.lit(True).alias("tail"))
    return (
        ranged(docs)
        .join(F.broadcast(small), F.col("doc_id").eqNullSafe(F.col("head")) & F.col("also").isNotNull(), "left")
        .select("doc_id", "text", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("to"))
        .select("doc_id", "text", "to.range", "to.tail")
        .repartition("range")
        .sortWithinPartitions("range", "tail", "doc_id", F.xxhash64("text"))
    )


def edited_fingerprints(docs: DataFrame, k: int = 8, ell: int = 2, m: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    small_batches(docs.sparkSession)
    source = ids_and_texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(frames):
        sketch = OrderMinHash(k, ell, m)
        previous, current = None, None
        for f in frames:
            out = []
            for doc_id, text, where, tail in zip(f["doc_id"], f["text"], f["range"], f["tail"]):
                if where != current:
                    previous, current = None, where
                if tail and previous is None:  # a further row of the next range's first id
                    continue
                own = sketch.tuples(text)
                if previous is not None:
                    last_id, last_text, last = previous
                    changed = edited_text(last_text, text)
                    edited = sketch.tuples(changed)
                    out.append((last_id, len(last_text), hashlib.sha256(changed.encode()).hexdigest(), as_string(last), as_string(edited), sketch.likeness(last, edited), sketch.likeness(last, own)))
                previous = None if tail else (doc_id, text, own)
            yield pd.DataFrame(out, columns=names)

    paired = with_next(source).withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return paired.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast(kind))
