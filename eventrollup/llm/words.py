"""Word and shingle hashes of many texts at once, on the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240115))
# A random odd 64-bit value for every byte, and odd multipliers for positions.
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_MULT = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


# Bytes of a word.  Every byte of a character above U+007F belongs to a word.
NOT_SPACE = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, "")
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.large_string())
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and for each text the
    number of words before it (one entry more than texts)."""
    inside = letters[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words with A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    within = np.arange(total) - np.repeat(first, sizes)
    at = within + np.repeat(starts, sizes)
    power = np.cumprod(np.full(int(sizes.max()), _STEP, dtype=np.uint64))
    value = _BYTE[_LOWER[data[at]]] * power[within]
    return mix(np.add.reduceat(value, first) + sizes.astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the DISTINCT k-word shingles of each text, ascending.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(offsets[-1], dtype=np.uint64)
    full = n >= k
    if full.any():
        size = count[full]
        begin = np.repeat(first[:-1][full], size) + _ramp(size)
        value = np.zeros(len(begin), dtype=np.uint64)
        for j in range(k):
            value += words[begin + j] * _MULT[j]
        out[np.repeat(offsets[:-1][full], size) + _ramp(size)] = mix(value)
    for i in np.flatnonzero((n > 0) & ~full):
        w = words[first[i]:first[i + 1]]
        salted = np.append(w * _MULT[:len(w)], np.array([len(w)], dtype=np.uint64) * _STEP)
        out[offsets[i]] = mix(np.sum(salted, dtype=np.uint64, keepdims=True))[0]
    owner = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((out, owner))
    out = out[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(n)))])


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0 .. size-1 for every size, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def ramp(sizes: np.ndarray) -> np.ndarray:
    return _ramp(np.asarray(sizes, dtype=np.int64))
