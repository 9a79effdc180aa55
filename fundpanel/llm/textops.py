"""Vectorised word splitting and hashing over Arrow string columns.

The helpers work on one Arrow batch inside a task.  Words are maximal runs of
bytes other than the six ASCII white-space bytes (0x20, 0x09-0x0D); UTF-8
continuation bytes never equal one of these, so byte positions and code points
agree about where words are.  Hashes are 64-bit and do not depend on the
process, the machine or the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_GOLD = U64(0x9E3779B97F4A7C15)
_M1 = U64(0xBF58476D1CE4E5B9)
_M2 = U64(0x94D049BB133111EB)

#: A slice of a batch holds at most this many bytes of text, or one text.
SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    with np.errstate(over="ignore"):
        x = x + _GOLD
        x = (x ^ (x >> U64(30))) * _M1
        x = (x ^ (x >> U64(27))) * _M2
        return x ^ (x >> U64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=U64) + U64(seed * int(_GOLD) % (1 << 64))) | U64(1)


_BYTE = seeded(256, 11)
_BASE = int(seeded(1, 12)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = np.empty(size, dtype=U64)
        out[0] = 1
        done, step = 1, base
        while done < size:
            take = min(done, size - done)
            out[done : done + take] = out[:take] * U64(step)
            done += take
            step = step * step % (1 << 64)
        have = _powers[base] = out
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null is an empty text."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.fill_null("").cast(pa.large_string())
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a batch between texts: (first text, past the last, bytes, offsets)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and for each text where its words begin (n + 1 positions)."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    if lower:
        data = _LOWER[data]
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    sums = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=sums[1:])
    out = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(out + (ends - starts).astype(U64)), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of all n consecutive words; those across two texts are for the caller to leave out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    out = np.zeros(count, dtype=U64)
    for j, k in enumerate(seeded(n, seed)):
        out += hashes[j : j + count] * k
    return mix(out)


def shingle_sets(column: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text the sorted distinct n-word shingles (as 64-bit hashes).

    A text of fewer words has its whole sequence as its only shingle; one without words has none.
    """
    data, offsets = utf8(column)
    for _, _, part, cuts in slices(data, offsets):
        found, first = words(part, cuts, lower)
        all_grams = grams(found, n, 21)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                yield np.unique(all_grams[a : b - n + 1])
            elif b > a:
                yield mix(np.array([(found[a:b] * seeded(int(b - a), 22)).sum(dtype=U64)]) + U64(b - a))
            else:
                yield np.zeros(0, U64)
