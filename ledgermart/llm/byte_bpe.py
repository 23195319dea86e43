"""Operator 7: byte-pair encoding by a dynamic programme over prefixes, and decoding.

For every prefix of a piece of text exactly one token can be the last one of the prefix's
encoding. An Aho-Corasick automaton (the vocabulary's trie with suffix links) reports every token
that ends at a position. Such a token is the last one if it starts the piece, or if the prefix
before it ends in a token it may stand beside: the pair must survive as it is when merging runs
over both, which ``seam`` decides from the ranks of the merges on either side of the seam.
Following the last tokens back from the end gives the ids. Time is linear in the text.

Pieces come from the byte-level splitting pattern, so words recur; their ids are remembered in
a bounded table. Special tokens inside a text get their id, as the library does by default.

Edge cases: null and empty texts have no ids and decode to the empty text; any Unicode text is
encoded whole, however long; repeated rows give repeated rows; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermart.llm.common import GenerationCache, held, ids_and_texts, map_texts

# Fixed value: the splitting pattern of byte-level vocabularies of this family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 60


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file, back to the byte.

    Printable Latin-1 characters stand for themselves; the rest follow from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def settled() -> str:
    """The characters of Unicode 3.2, as ranges of a character class."""
    early = unicodedata.ucd_3_2_0.category
    points = [c for c in range(0x110000) if early(chr(c)) not in ("Cn", "Cs")]
    out, first = [], points[0]
    for c, after in zip(points, [*points[1:], None]):
        if after != c + 1:
            out.append(f"\\U{first:08x}-\\U{c:08x}")
            first = after
    return "".join(out)


class PrefixEncoder:
    """Encodes and decodes as the byte-level BPE tokenizer in the JSON file ``path``."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or spec["normalizer"] or model["dropout"] or model["ignore_merges"]:
            raise ValueError("a byte-level BPE file without normaliser is needed")
        byte = printable_bytes()
        spelled = lambda s: bytes(byte[c] for c in s)
        vocab = {spelled(s): i for s, i in model["vocab"].items()}
        self.text_of = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of |= {i: s.encode() for s, i in self.special.items()}
        #: rank of the merge of two ids; by id: rank of the merge that makes it and its halves
        self.rank, self.born, self.halves = {}, {i: -1 for i in vocab.values()}, {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (vocab[spelled(s)] for s in (pair if isinstance(pair, list) else pair.split(" ")))
            made = vocab[self.text_of[left] + self.text_of[right]]
            self.rank[left, right] = rank
            if self.born[made] < 0:
                self.born[made], self.halves[made] = rank, (left, right)
        self.automaton = ahocorasick.Automaton()
        whole = {i for i in vocab.values() if self.born[i] < 0}
        for i, pair in sorted(self.halves.items(), key=lambda x: self.born[x[0]]):
            # a token that merging its own bytes doesn't give can't occur
            if whole.issuperset(pair) and self.seam(*pair) == pair:
                whole.add(i)
        for s, i in vocab.items():
            if i in whole:
                self.automaton.add_word(s.decode("latin-1"), (i, len(s)))
        self.automaton.make_automaton()
        self.split = regex.compile(PATTERN)
        # classes of characters depend on the Unicode version: texts with a character that an early one
        # doesn't have are split by the library itself
        from tokenizers import Tokenizer

        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.later = re.compile(f"[^{settled()}]")
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.fits = GenerationCache(lambda pair: self.seam(*pair) is None, 300_000)
        self.memo = GenerationCache(self.encode_piece)

    def seam(self, left: int, right: int) -> tuple[int, int] | None:
        """The first two symbols that merge across the seam of two tokens; None if they stay apart.

        The seam is first between the innermost symbols: the end of ``left`` and the start of
        ``right``. Each side grows outwards with its own merges in order of rank. The symbols at
        the seam merge if their rank comes before the next merge of either side; at equal rank
        the leftmost goes first, so it comes before the right side's but not the left's.
        """
        lefts, rights = [left], [right]
        while lefts[-1] in self.halves:
            lefts.append(self.halves[lefts[-1]][1])
        while rights[-1] in self.halves:
            rights.append(self.halves[rights[-1]][0])
        a, b = lefts.pop(), rights.pop()
        while True:
            next_left = self.born[lefts[-1]] if lefts else NEVER
            next_right = self.born[rights[-1]] if rights else NEVER
            joined = self.rank.get((a, b), NEVER)
            if joined < next_left and joined <= next_right and joined < NEVER:
                return a, b
            if next_left == next_right == NEVER:
                return None
            if next_left <= next_right:
                a = lefts.pop()
            else:
                b = rights.pop()

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        n, fits = len(data), self.fits
        last, size = [-1] * (n + 1), [0] * (n + 1)
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            if last[end + 1] < 0:
                start = end + 1 - length
                if start == 0 or fits[last[start], token]:
                    last[end + 1], size[end + 1] = token, length
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= size[at]
        return tuple(ids[::-1])

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        if self.apart and any(s in text for s in self.special):
            parts = self.apart.split(text)
        else:
            parts = [text]
        memo, special = self.memo, self.special
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(special[part])
                continue
            for piece in self.pieces(part):
                ids.extend(memo[piece] if len(piece) < 64 else self.encode_piece(piece))
        return ids

    def pieces(self, part: str) -> list[str]:
        if part.isascii() or not self.later.search(part):
            return self.split.findall(part)
        return [part[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(part)]

    def decode(self, ids) -> str:
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


def loaded(path: str) -> PrefixEncoder:
    return held(("prefixes", path), lambda: PrefixEncoder(path))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ids (array of int). One map over the texts, no shuffle."""

    def make():
        coder = loaded(model)
        return lambda text: (coder.encode(text),)

    return map_texts(ids_and_texts(docs, id_col, text_col), "ids array<int>", make)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id and text, the reverse of ``encode``; null ids count as none."""

    def make():
        coder = loaded(model)
        return lambda ids: (coder.decode(ids),)

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    found = map_texts(encoded.select(F.col(id_col).alias("doc_id"), ids.alias("text")), "decoded string", make)
    return found.withColumnRenamed("decoded", "text")


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (little-endian 32-bit ids), decoded_sha256 (UTF-8).

    Encoding and decoding run in one pass, so the ids never leave the worker.
    """

    def make():
        coder, sha = loaded(model), hashlib.sha256

        def each(text):
            ids = coder.encode(text)
            return len(ids), sha(array("I", ids).tobytes()).hexdigest(), sha(coder.decode(ids).encode()).hexdigest()

        return each

    return map_texts(ids_and_texts(docs, id_col, text_col), "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
