"""Fingerprints, encodings, counts and packing against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermart.llm import byte_bpe, order_minhash, packing, piece_count
from tests.llm.helpers import awkward, awkward_rows, empty, frame, words

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = st.text(st.one_of(st.sampled_from("ab 'sS\n\t.,!<|>İΣ1½中é́▁  \x1c\x85😀"), st.characters(exclude_categories=["Cs"])), max_size=40)
MIXED = st.lists(st.one_of(ODD, st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<s>", "<unk>", "<0x41>", "   ", "the ", "'ll", "İ,"])), max_size=6).map("".join)


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_prefix_encoding_equals_the_library(text):
    coder, lib = byte_bpe.loaded(BYTE), library_once(BYTE)
    ids = lib.encode(text, add_special_tokens=False).ids
    assert coder.encode(text) == ids
    assert coder.decode(ids) == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_word_ids_equal_the_library(text):
    ids = np.frombuffer(packing.loaded(WORD).encode(text), "<u4").tolist()
    assert ids == library_once(WORD).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_piece_counts_equal_the_library(text):
    import sentencepiece

    lib = _ONCE.setdefault(PIECE, None) or _ONCE.__setitem__(PIECE, sentencepiece.SentencePieceProcessor(model_file=PIECE)) or _ONCE[PIECE]
    assert piece_count.loaded(PIECE).count(text) == len(lib.encode(text))


def test_every_code_point_is_encoded_as_the_library_does():
    """Alone, after a letter, before a full stop, a comma and a contraction."""
    coder, word = byte_bpe.loaded(BYTE), packing.loaded(WORD)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    late = [c for c in points if coder.later.search(c)]
    early = sorted(set(points) - set(late))
    assert len(late) > 17_480 and len(early) > 90_000
    # planes of which nothing is assigned are alike: every 64th of them
    late = [c for c in late if ord(c) < 0x20000 or ord(c) >= 0xE0000 and ord(c) < 0xE1000 or ord(c) % 64 == 0]
    for group in (early, late):
        for lo in range(0, len(group), 500):
            forms = [f for c in group[lo : lo + 500] for f in (c, f"a{c}", f"{c}.", f"{c},", f"{c}'re", f"x{c}y.")]
            text = " ".join(forms)
            lib = library_once(BYTE).encode(text, add_special_tokens=False).ids
            if coder.encode(text) != lib:
                bad = [f for f in forms if coder.encode(f) != library_once(BYTE).encode(f, add_special_tokens=False).ids]
                raise AssertionError(f"byte: {[hex(ord(max(f))) for f in bad][:9]}")
            if np.frombuffer(word.encode(text), "<u4").tolist() != library_once(WORD).encode(text, add_special_tokens=False).ids:
                bad = [f for f in forms if np.frombuffer(word.encode(f), "<u4").tolist() != library_once(WORD).encode(f, add_special_tokens=False).ids]
                raise AssertionError(f"word: {[hex(ord(max(f))) for f in bad][:9]}")


_ONCE: dict = {}


def library_once(path):
    if path not in _ONCE:
        _ONCE[path] = library(path)
    return _ONCE[path]


def test_long_pieces_are_encoded_whole():
    for text in ("a" * 5000, " " * 3000, "ab" * 2000 + "\n" * 500, "xyz" * 1500):
        assert byte_bpe.loaded(BYTE).encode(text) == library_once(BYTE).encode(text, add_special_tokens=False).ids
        assert packing.loaded(WORD).encode(text) == np.array(library_once(WORD).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_every_short_prefix_has_one_encoding():
    rng, coder, lib = random.Random(5), byte_bpe.loaded(BYTE), library_once(BYTE)
    text = words(rng, 30)
    for n in range(len(text)):
        assert coder.encode(text[:n]) == lib.encode(text[:n], add_special_tokens=False).ids


def test_round_trip_over_awkward_rows(spark):
    found = byte_bpe.round_trip(awkward(spark), BYTE).collect()
    assert len(found) == len(awkward_rows())
    lib = library_once(BYTE)
    expected = []
    for doc_id, text in awkward_rows():
        ids = lib.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (str(r[0]), r[2])
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)
    back = byte_bpe.decode(byte_bpe.encode(awkward(spark), BYTE), BYTE).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), t or "") for i, t in awkward_rows())
    assert byte_bpe.round_trip(empty(spark), BYTE).count() == 0


def test_counts_over_awkward_rows(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    found = piece_count.count_tokens(awkward(spark), PIECE, limit=100).collect()
    expected = []
    for doc_id, text in awkward_rows():
        n = len(lib.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert piece_count.count_tokens(empty(spark), PIECE).count() == 0


def test_stretches_are_cut_only_where_no_piece_reaches():
    counter = piece_count.loaded(PIECE)
    assert all(counter.stretches.fullmatch(p) for p in counter.rank)


# --- packing -----------------------------------------------------------------


def packed(df, **more):
    return [r.asDict() for r in packing.pack(df, WORD, **more).collect()]


def assert_whole(pieces, rows, window):
    lib, tokens = library_once(WORD), defaultdict(list)
    for p in pieces:
        assert 0 < p["length"] <= window and len(p["ids"]) == 4 * p["length"]
        tokens[p["doc_id"], p["doc_tokens"]].append(p)
    expected = defaultdict(list)
    for doc_id, text in rows:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        expected[doc_id, len(ids)] += [np.array(ids, "<u4").tobytes()]
    assert set(tokens) == set(expected)
    for key, texts in expected.items():
        assert sum(p["length"] for p in tokens[key]) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            own = sorted(tokens[key], key=lambda p: p["start"])
            assert b"".join(bytes(p["ids"]) for p in own) == texts[0]
            assert [p["start"] for p in own] == list(np.cumsum([0] + [p["length"] for p in own])[:-1])
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda p: p["offset"])
        size = sum(p["length"] for p in own)
        assert [p["offset"] for p in own] == list(np.cumsum([0] + [p["length"] for p in own])[:-1])
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    return padding


def test_packing_keeps_every_token_once(spark):
    rng = random.Random(11)
    rows = [(i, words(rng, rng.choice([0, 1, 5, 40, 300]))) for i in range(200)]
    for block_docs in (1000, 30):
        assert assert_whole(packed(frame(spark, rows), window=128, block_docs=block_docs), rows, 128) == 0


def test_blocks_are_large_enough_to_find_complements(spark):
    rng = random.Random(13)
    df = frame(spark, [(i, words(rng, rng.randint(2, 30))) for i in range(6000)])
    large, small = packed(df, window=256), packed(df, window=256, block_docs=2_000)
    assert len({p["sequence_id"] // packing.SPAN for p in large}) == 1
    # only poured documents are cut; none of these is longer than a window
    assert 2 * (len(large) - 6000) < len(small) - 6000


def test_packing_awkward_rows(spark):
    assert assert_whole(packed(awkward(spark), window=64), awkward_rows(), 64) == 0
    assert packed(empty(spark)) == []
    a, b = (packed(frame(spark, [(i, f"a b {i}") for i in range(50)]).repartition(n), window=16) for n in (1, 7))
    assert sorted(a, key=str) == sorted(b, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_each_rest_goes_where_the_sum_of_squares_is_least(sizes):
    window, packer = 16, packing.Packer(16)
    for size in sizes:
        before = packer.counts.copy()

        def after(level):
            n = before.copy()
            if level:
                n[level] -= 1
            if level + size < window:
                n[level + size] += 1
            return int((n[1:window] ** 2).sum())

        allowed = [0, *[h for h in range(1, window - size + 1) if before[h]]]
        assert after(packer.level_for(size)) == min(map(after, allowed))
        list(packer.place("d", np.arange(size, dtype="<u4")))


# --- fingerprints ------------------------------------------------------------


def test_edited_fingerprints_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(i * 7 % 101, words(rng, rng.choice([1, 30, 200]))) for i in range(101)]
    rows[5] = (rows[5][0], rows[6][1])
    found = {r["doc_id"]: r for r in order_minhash.edited_fingerprints(frame(spark, rows).repartition(5)).collect()}
    assert len(found) == 101
    ordered, sketch = sorted(rows), order_minhash.OrderMinHash()
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        edited = order_minhash.edited_text(text, following)
        r = found[doc_id]
        own, changed, other = (sketch.tuples(t) for t in (text, edited, following))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == order_minhash.as_string(own) and r["edited_fingerprint"] == order_minhash.as_string(changed)
        assert r["near_edited"] == sketch.likeness(own, changed) and r["near_next"] == sketch.likeness(own, other)
    long = [found[d] for d, t in ordered if len(t) > 100]
    assert min(r["near_edited"] for r in long) > 0.3 > max(r["near_next"] for r in long)


def naive_tuples(sketch, text):
    """The same choice made one hash function at a time."""
    kmers = sketch.numbered(text)
    out = []
    for salt, factor in zip(sketch.salts[:, 0], sketch.factors[:, 0]):
        value = (kmers.astype(np.uint32) ^ salt) * factor
        least = sorted(range(len(kmers)), key=lambda i: (value[i], i))[: sketch.ell]
        h = np.full(1, len(least), np.uint64)
        for i in sorted(least):
            h = order_minhash._mixed(h * order_minhash.MIX + kmers[i])
        out.append(int(h[0]) & ((1 << order_minhash.BITS) - 1))
    return out


def test_blocks_don_t_change_the_choice(monkeypatch):
    text = words(random.Random(4), 60)
    for ell in (1, 2, 3):
        sketch = order_minhash.OrderMinHash(ell=ell, m=8)
        for block in (4096, 100, 7):
            monkeypatch.setattr(order_minhash, "BLOCK", block)
            assert sketch.tuples(text).tolist() == naive_tuples(sketch, text)


def test_k_mers_are_numbered_by_occurrence():
    kmers = order_minhash.OrderMinHash(k=2).numbered("abababab")
    assert len(kmers) == 7 and len(set(kmers.tolist())) == 7
    again = order_minhash.OrderMinHash(k=2).numbered("ababab")
    assert kmers[:5].tolist() == again.tolist()


def test_order_matters():
    rng, sketch = random.Random(9), order_minhash.OrderMinHash(ell=3)
    parts = [words(rng, 12) for _ in range(20)]
    text, moved = " ".join(parts), " ".join(reversed(parts))
    near = text[:700] + "x" + text[701:]
    one = sketch.tuples(text)
    assert sketch.likeness(one, sketch.tuples(near)) > 0.8
    assert sketch.likeness(one, sketch.tuples(moved)) < sketch.likeness(one, sketch.tuples(near)) - 0.1
    assert sketch.likeness(one, sketch.tuples(text)) == 1


def test_fingerprints_of_awkward_rows(spark):
    found = order_minhash.edited_fingerprints(awkward(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in awkward_rows())
    plain = order_minhash.fingerprints(awkward(spark)).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in plain) == sorted((str(r["doc_id"]), r["fingerprint"]) for r in found)
    assert order_minhash.edited_fingerprints(empty(spark)).count() == 0
    one = order_minhash.edited_fingerprints(frame(spark, [(3, "abcdefghij")])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abcdefghab").hexdigest()


@pytest.mark.parametrize("seed", [0, 1])
def test_crc_of_a_piece_is_over_its_ids(spark, seed):
    from pyspark.sql import functions as F

    rows = [(i, words(random.Random(seed + i), 9)) for i in range(4)]
    for r in packing.pack(frame(spark, rows), WORD, window=8).withColumn("crc", F.crc32("ids")).collect():
        assert r["crc"] == zlib.crc32(bytes(r["ids"]))


def test_every_latin_letter_alone_and_in_a_word():
    coder, lib = packing.loaded(WORD), library_once(WORD)
    assert coder.by_model
    for i in range(0x21, 0x260):
        for text in (chr(i), f"ab{chr(i)}", f"{chr(i)}cd", f"a{chr(i)}b,", f"{chr(i)}{chr(i)}."):
            assert np.frombuffer(coder.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text
