"""Vectorised scanning of UTF-8 bytes: words, span hashes and n-gram hashes, with NumPy.

Hashes are polynomials over 64-bit integers (a random odd base, a random value for each byte), taken from
prefix sums, so the hash of any span costs two look-ups. Scans go in chunks: the memory beside the text is a
few bytes a word, and that of one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 17
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(out, out=out)
    return out


POWER = _powers(_BASE, CHUNK + 1)
INVERSE = _powers(_INVERSE, CHUNK)
INVERSE_BLOCK = _powers(pow(_INVERSE, CHUNK, 1 << 64), 1 << 12)

BYTE_VALUE = np.random.Generator(np.random.PCG64(20240917)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_LOWER = BYTE_VALUE.copy()
BYTE_VALUE_LOWER[65:91] = BYTE_VALUE[97:123]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_CONTINUATION = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each value of a string column, without copying; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    for i in range(len(column)):
        yield data[at[i] : at[i + 1]]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words, maximal runs without ASCII white space."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    if not space[-1]:
        edge = np.concatenate((edge, [n]))
    return edge[0::2], edge[1::2]


def prefix_at(data: np.ndarray, at: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Prefix hashes at ascending positions ``at`` (0 to len(data))."""
    out = np.zeros(len(at), np.uint64)
    carry, lift = np.uint64(0), 1
    for base in range(0, max(len(data), 1), CHUNK):
        part = data[base : base + CHUNK]
        lo, hi = np.searchsorted(at, (base, base + len(part)), "left")
        if base + len(part) == len(data):
            hi = len(at)
        terms = value[part]
        terms *= POWER[: len(part)]
        if lift != 1:
            terms *= np.uint64(lift)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = carry
        np.cumsum(terms, out=sums[1:])
        sums[1:] += carry
        out[lo:hi] = sums[at[lo:hi] - base]
        carry = sums[-1]
        lift = lift * int(POWER[CHUNK]) & _MASK
    return out


def _down(at: np.ndarray) -> np.ndarray:
    """The inverse of the base to the power ``at``."""
    block = at // CHUNK
    if len(at) and block[-1] >= len(INVERSE_BLOCK):
        high = np.array([pow(_INVERSE, CHUNK * int(b), 1 << 64) for b in range(int(block[-1]) + 1)], np.uint64)
    else:
        high = INVERSE_BLOCK
    return INVERSE[at % CHUNK] * high[block]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Hashes of ascending, non-overlapping spans; equal bytes give equal hashes anywhere."""
    h = prefix_at(data, ends, value) - prefix_at(data, starts, value) if len(data) > CHUNK else None
    if h is None:
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(value[data] * POWER[: len(data)], out=sums[1:])
        h = sums[ends] - sums[starts]
    return mix(h * _down(starts) + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words, A-Z counted as a-z."""
    starts, ends = word_bounds(data)
    return starts, ends, span_hashes(data, starts, ends, BYTE_VALUE_LOWER)


_STEP = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in order; fewer words count as one run, none as no run."""
    n = len(words)
    if not n:
        return words[:0]
    size = min(k, n)
    out = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        out += words[j : n - size + 1 + j] * _STEP[j % 64]
    return mix(out + np.uint64(size))
