"""Sets of hashed word shingles of whole texts, made for a batch of texts at once in numpy."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A full-avalanche mix of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * MIX)


#: Characters of texts that are hashed together, so that the arrays stay small.
TOGETHER = 200_000


def shingle_sets(texts: list[str], width: int = 3) -> list[np.ndarray]:
    """``sets_together`` of runs of texts with about ``TOGETHER`` characters."""
    out, run, size = [], [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= TOGETHER:
            out += sets_together(run, width)
            run, size = [], 0
    return out + sets_together(run, width) if run else out


def sets_together(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``width`` words.

    Words are runs without ASCII white space, A-Z lower-cased. With fewer than ``width`` words the
    whole sequence is one shingle; without words the set is empty.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    bounds = np.cumsum([len(r) + 1 for r in raw])
    space = _SPACE[joined]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    ends = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]]))
    length = ends - starts
    # a polynomial in the place within the word, over a random number for each byte
    powers = np.cumprod(np.full(int(length.max()) + 1, MIX))
    flat = np.flatnonzero(~space)
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(len(flat)) - np.repeat(first, length)
    words = mixed(np.add.reduceat(_BYTE[joined[flat]] * powers[place], first) + length.astype(np.uint64))
    owner_end = np.searchsorted(starts, bounds)
    # a shingle's hash folds its words from the last to the first
    full = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width - 1, -1, -1):
        full = mixed(full * MIX + words[i : i + len(full)])
    out, lo = [], 0
    for hi in owner_end.tolist():
        n = hi - lo
        if n >= width:
            out.append(np.unique(full[lo : hi - width + 1]))
        elif n:
            short = np.full(1, n, np.uint64)
            for w in words[lo:hi][::-1]:
                short = mixed(short * MIX + w)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        lo = hi
    return out
