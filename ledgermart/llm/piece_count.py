"""Operator 9: token counts by heap-and-linked-list merging, without making identifiers.

The symbols of a stretch of text form a doubly linked list. A heap holds the adjacent pairs that
the vocabulary can merge, lowest rank first and leftmost among equals. Each pop that is still
valid joins two neighbours and pushes the at most two new pairs beside them. The count is the
initial symbols minus the merges; a symbol left outside the vocabulary counts its UTF-8 bytes
(byte fallback).

Text is cut into stretches where no piece of the vocabulary can reach across: before each
space-mark that follows another character, and between letters and other characters. That is
checked against the vocabulary when it is loaded (one with a piece across such a cut is refused),
so a stretch can be counted on its own and its count remembered.

Edge cases: null and empty texts have 0 tokens; any Unicode text is counted whole, however long;
repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import heapq

import regex
from pyspark.sql import DataFrame

from ledgermart.llm.common import GenerationCache, held, ids_and_texts, map_texts

SPACE = "▁"


class PieceCounter:
    """Counts pieces as the sentencepiece BPE model in ``path`` makes them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        piece = pb.ModelProto.SentencePiece
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or kinds & {piece.USER_DEFINED, piece.UNUSED}:
            raise ValueError("only models without normalisation, user-defined or unused pieces are supported")
        # a higher score merges first; the id breaks no ties, position does
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == piece.NORMAL}
        self.stretches = regex.compile(rf"(?V1){SPACE}*+(?:[^\W\d_]++|[[\W\d_]--{SPACE}]++)|{SPACE}++")
        if not all(map(self.stretches.fullmatch, self.rank)):
            raise ValueError("a piece reaches across a cut between stretches")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.memo = GenerationCache(self.count_stretch)

    def count_stretch(self, s: str) -> int:
        n, rank = len(s), self.rank
        sym = list(s)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            r = rank.get(s[i : i + 2])
            if r is not None:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, size = heapq.heappop(heap)
            left = sym[i]
            j = nxt[i]
            # stale: one side was merged meanwhile (its length changed or it is gone)
            if not left or j >= n or len(left) + len(sym[j]) != size:
                continue
            joined = sym[i] = left + sym[j]
            sym[j] = ""
            k = nxt[i] = nxt[j]
            merges += 1
            if k < n:
                prev[k] = i
                both = joined + sym[k]
                r = rank.get(both)
                if r is not None:
                    heapq.heappush(heap, (r, i, len(both)))
            h = prev[i]
            if h >= 0:
                both = sym[h] + joined
                r = rank.get(both)
                if r is not None:
                    heapq.heappush(heap, (r, h, len(both)))
        spelled = sum(len(x.encode()) - 1 for x in sym if x and x not in rank)
        return n - merges + spelled

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = self.prefix + text.replace(" ", SPACE)
        memo, total, long = self.memo, 0, self.count_stretch
        for s in self.stretches.findall(marked):
            total += memo[s] if len(s) < 64 else long(s)
        return total


def loaded(path: str) -> PieceCounter:
    return held(("pieces", path), lambda: PieceCounter(path))


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    One map over the texts, no shuffle.
    """

    def make():
        count = loaded(model).count

        def each(text):
            n = count(text)
            return len(text.encode()), n, n > limit

        return each

    return map_texts(ids_and_texts(docs, id_col, text_col), "n_bytes bigint, n_tokens bigint, over_limit boolean", make)
