"""Operator 3: exact dedup with two passes over a Bloom filter.

Pass 1 enters a 64-bit hash of every text into a filter that tells bits hit once from bits hit at
least twice. Pass 2 looks every hash up: a text whose bits were all hit at least twice may be
repeated, any other certainly stands alone and passes straight through. Only the possibly repeated
rows shuffle, on the SHA-256 of the text, where the groups are counted exactly; a filter's false
alarm is a group of one. The result never depends on the filter.

The filter is cut into segments of 65,536 bits, and both bits of a text lie in one segment. Tasks
send sorted lists of hit bits per segment, which are folded one after another into the segment's
bitmap. Its size follows the row count up to ``max_segments`` (8 KiB each, 32 MiB in all), which
bounds what is broadcast; on more rows the filter is fuller and more rows take the shuffle of
about 50 bytes a row, never the texts.

Edge cases: null and empty texts are equal to each other; of equal texts the row with the largest
id stays, null ids being smallest, and of rows that repeat this id one; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import scratch_table, small_batches, text_of

SEGMENT_BITS = 1 << 16
BITS_PER_ROW = 16
MAX_SEGMENTS = 4096
#: Hashes that a task gathers before it sends the bits hit.
FLUSH = 1 << 20


def segments_for(rows: int, max_segments: int = MAX_SEGMENTS) -> int:
    wanted = max(1, -(-rows * BITS_PER_ROW // SEGMENT_BITS))
    return min(max_segments, 1 << (wanted - 1).bit_length())


def hit_bits(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, bit, bit) of unsigned 64-bit hashes."""
    return (hashes >> np.uint64(32)) % np.uint64(segments), hashes & np.uint64(0xFFFF), hashes >> np.uint64(16) & np.uint64(0xFFFF)


def filter_of(hashes: DataFrame, segments: int) -> DataFrame:
    """One row per segment hit: segment, and 1,024 words each of bits hit at all (once) and at least twice (twice)."""

    def sent(parts):
        segment, one, two = hit_bits(np.concatenate(parts), segments)
        # a text whose bits coincide hits that bit once
        places = np.concatenate([segment << np.uint64(16) | one, (segment << np.uint64(16) | two)[one != two]])
        places, times = np.unique(places, return_counts=True)
        owner = (places >> np.uint64(16)).astype(np.int64)
        bit = (places & np.uint64(0xFFFF)).astype("<u2")
        cuts = np.flatnonzero(np.diff(owner)) + 1
        rows = [(int(o[0]), b.tobytes(), b[t > 1].tobytes()) for o, b, t in zip(np.split(owner, cuts), np.split(bit, cuts), np.split(times, cuts))]
        return pd.DataFrame(rows, columns=["segment", "once", "twice"])

    def gather(frames):
        parts, held = [], 0
        for f in frames:
            parts.append(f["hash"].to_numpy().astype(np.int64).view(np.uint64))
            held += len(f)
            if held >= FLUSH:
                yield sent(parts)
                parts, held = [], 0
        if held:
            yield sent(parts)

    def fold(frames):
        current, once, twice = None, None, None

        def bitmap():
            words = [np.packbits(x, bitorder="little").view("<i8") for x in (once, twice)]
            return pd.DataFrame({"segment": [current], "once": [words[0]], "twice": [words[1]]})

        for f in frames:
            for segment, hit, again in zip(f["segment"], f["once"], f["twice"]):
                if segment != current:
                    if current is not None:
                        yield bitmap()
                    current, once, twice = segment, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
                bits = np.frombuffer(hit, "<u2")
                twice[bits[once[bits]]] = True
                once[bits] = True
                twice[np.frombuffer(again, "<u2")] = True
        if current is not None:
            yield bitmap()

    return (
        hashes.mapInPandas(gather, "segment bigint, once binary, twice binary")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInPandas(fold, "segment bigint, once array<bigint>, twice array<bigint>")
    )


def looked_up(keys: DataFrame, filtered: DataFrame, segments: int, bits: str = "twice") -> DataFrame:
    """``keys`` with the column ``maybe``: both bits of its ``hash`` are set in the filter's ``bits``.

    The filter has at most ``MAX_SEGMENTS`` rows of 8 KiB, which bounds the broadcast.
    """
    looked = keys.withColumn("segment", F.expr(f"pmod(shiftrightunsigned(hash, 32), {segments}L)"))
    bit = lambda b: f"(shiftright(words[cast({b} div 64 as int)], cast({b} % 64 as int)) & 1) = 1"
    one, two = "(hash & 65535)", "(shiftrightunsigned(hash, 16) & 65535)"
    small = F.broadcast(filtered.select("segment", F.col(bits).alias("words")))
    return looked.join(small, "segment", "left").withColumn("maybe", F.expr(f"coalesce({bit(one)} and {bit(two)}, false)")).drop("segment", "words")


def dedup(docs: DataFrame, max_segments: int = MAX_SEGMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    small_batches(docs.sparkSession)
    text = text_of(text_col)
    keys = scratch_table(
        docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("hash")).withColumn("row", F.monotonically_increasing_id()),
        "text-keys",
    )
    segments = segments_for(keys.count(), max_segments)
    hits = scratch_table(filter_of(keys.select("hash"), segments), "bloom")
    looked = looked_up(keys, hits, segments)

    alone = looked.where(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha")
    again = looked.where("maybe").select("doc_id", "row", "sha")
    # written, so that the join reads two plain shuffles and a large group's rows can be split over tasks
    groups = scratch_table(again.groupBy("sha").agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size")), "text-groups")
    exact = again.join(groups, "sha", "left").select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), "sha")
    return alone.unionByName(exact).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
