"""Operator 8: pack token streams into windows by the sum-of-squares rule.

Documents are dealt into blocks by a hash of their id; each block packs alone, one document after
another. Whole windows of a document are cut off first. Its rest goes into the fill level that
makes the sum over levels of squared counts of partly filled windows smallest; the counts are one
array indexed by level, so a choice is one vectorised expression over the levels. Rests so keep
finding complements, and few windows stay open. When a block ends, what its open windows hold is
poured together and cut at the window size, and the last piece of window at powers of two, which
need no padding.

A block holds about ``block_docs`` documents whatever the corpus size: many times the fill levels, so
that the rule finds complements and little is left to pour. A task keeps open windows only, whose
number follows the levels and not the documents, and texts stream through in small batches. Sequences are
numbered block by block.

Edge cases: null and empty texts give the end id alone; texts of any length are cut freely; rows
repeated with the same id are packed as often as they occur; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.byte_bpe import printable_bytes
from ledgermart.llm.common import GenerationCache, held, ids_and_texts, small_batches

#: Sequence ids are block * SPAN + number within the block.
SPAN = 1 << 32
# The normaliser and splitting pattern for which ``encode_run`` may use the model alone.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordCoder:
    """Ids of the library's tokenizer in ``path``, remembered for each run without white space.

    Only for tokenizers that drop white space: what they do to one run doesn't depend on others.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.memo = GenerationCache(self.encode_run, 700_000)
        self.parted = GenerationCache(self.split_apart, 10_000)
        # words of plain Latin letters need the library's model alone: they are in normal form, lower
        # case is letter by letter, and splitting leaves them whole; the model reads bytes as characters
        spec = json.loads(self.library.to_str())
        self.by_model = spec["normalizer"] == NORMALIZER and any(p.get("pattern") == {"Regex": SPLIT} for p in spec["pre_tokenizer"].get("pretokenizers", []))
        self.model = self.library.model
        self.as_read = str.maketrans({chr(b): c for c, b in printable_bytes().items()})
        probe = ["ab cd", "1 a", "a ' s", "a b", "! ?\n!", "a ́b"]
        if any(self.encode(p) != b"".join(map(self.encode_run, p.split())) for p in probe) or any(
            self.encode_run(p) != b"".join(map(self.encode_run, p.split(" "))) for p in probe
        ):
            raise ValueError("a tokenizer that drops white space is needed")

    def split_apart(self, two: str) -> bool:
        """The library splits a letter from the sign after it: a normal form may end in a mark that joins the sign."""
        count = lambda s: len(self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(s)))
        return count(two) == count(two[0]) + 1 and count(two[0]) == 1

    def encode_run(self, run: str) -> bytes:
        if len(run) > 1 and run[-1] in ",." and run[-2].isalpha() and self.parted[run[-2:]]:
            # the word shares its entry with the word alone
            return self.memo[run[:-1]] + self.memo[run[-1]]
        if self.by_model and run.isalpha():
            low = run.lower()
            if run.isascii():
                return array("I", [t.id for t in self.model.tokenize(low)]).tobytes()
            if max(run) < "\u0250" and low.isalpha():
                return array("I", [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(self.as_read))]).tobytes()
        return array("I", self.library.encode(run, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        runs = re.split("[ \t\n\r\f\v]+", text) if re.search("[\x1c-\x1f]", text) else text.split()
        memo = self.memo
        return b"".join([memo[r] if len(r) < 64 else self.encode_run(r) for r in runs])


def loaded(path: str) -> WordCoder:
    return held(("words", path), lambda: WordCoder(path))


class Packer:
    """One block's windows. ``place`` and ``finish`` yield (sequence, offset, piece).

    A piece is (document key, start in the document, ids).
    """

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.sequences = 0

    def closed(self, pieces):
        offset = 0
        for piece in pieces:
            yield self.sequences, offset, piece
            offset += len(piece[2])
        self.sequences += 1

    def level_for(self, size: int) -> int:
        """Where a rest of ``size`` makes the sum of squared counts smallest.

        Level h loses a window and level h + size gains one: the sum changes by
        2 * (n[h + size] - n[h]) + 2; a new window only adds, a full window only removes.
        On equal terms the fuller window wins, so that it closes sooner.
        """
        n = self.counts
        last = self.window - size
        change = 2 * (n[size : self.window + 1] - n[: last + 1]) + 2
        change[0] = 2 * n[size] + 1
        change[last] = 1 - 2 * n[last]
        change[1:][n[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def place(self, key, ids):
        window, start = self.window, 0
        while len(ids) - start >= window:
            yield from self.closed([(key, start, ids[start : start + window])])
            start += window
        size = len(ids) - start
        if not size:
            return
        level = self.level_for(size)
        pieces = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        pieces.append((key, start, ids[start:]))
        if level + size == window:
            yield from self.closed(pieces)
        else:
            self.counts[level + size] += 1
            self.open[level + size].append(pieces)

    def finish(self):
        left = sum(h * int(self.counts[h]) for h in range(self.window))
        room, pieces = min(self.window, _power_below(left, self.window)), []
        need = room
        for level in range(self.window - 1, 0, -1):
            for held in self.open[level]:
                for key, start, ids in held:
                    while len(ids):
                        part = ids[:need]
                        pieces.append((key, start, part))
                        start, ids = start + len(part), ids[len(part) :]
                        need -= len(part)
                        if not need:
                            yield from self.closed(pieces)
                            left -= room
                            room, pieces = _power_below(left, self.window), []
                            need = room


def _power_below(left: int, window: int) -> int:
    """The next sequence's length: a whole window, or else the largest power of two that is left."""
    return window if left >= window else 1 << (left.bit_length() - 1) if left else 0


def pack(docs: DataFrame, model: str, window: int = 2048, end_id: int = 1, block_docs: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    One shuffle, of the texts, into the blocks. The number of blocks follows the row count.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = ids_and_texts(docs, id_col, text_col)
    # each block holds about block_docs documents; one job counts rows from the file footers
    blocks = max(1, -(-source.count() // block_docs))
    kind = source.schema["doc_id"].dataType
    keyed = source.withColumn("doc_id", F.col("doc_id").cast("string"))
    dealt = keyed.withColumn("block", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(blocks)))

    def run(frames):
        code, end = loaded(model).encode, np.array([end_id], dtype="<u4")
        packer, current = None, None

        def frame(found):
            rows = [(key[0], start, len(ids), ids.tobytes(), key[1], current * SPAN + seq, offset) for seq, offset, (key, start, ids) in found]
            return pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for f in frames:
            found = []
            for doc_id, text, block in zip(f["doc_id"], f["text"], f["block"]):
                if block != current:
                    if packer:
                        found += packer.finish()
                        yield frame(found)
                        found = []
                    packer, current = Packer(window), int(block)
                ids = np.concatenate([np.frombuffer(code(text), dtype="<u4"), end])
                found += packer.place((doc_id, len(ids)), ids)
            yield frame(found)
        if packer:
            yield frame(packer.finish())

    return (
        dealt.repartition("block")
        .sortWithinPartitions("block", F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .mapInPandas(run, "doc_id string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )
