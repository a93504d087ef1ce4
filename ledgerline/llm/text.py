"""Whole Arrow text columns as bytes: words and word hashes without a Python object per word."""

from __future__ import annotations

import numpy as np

# The white space of the word rule [^\x20\x09-\x0D]+ (fixed values).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a pyarrow string column and the n+1 offsets of its rows; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, max_bytes: int):
    """The rows of a pyarrow string column in order, cut into pieces of about ``max_bytes`` (one row at least)."""
    _, offsets = text_bytes(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + max_bytes, "right")) - 1)
        yield column.slice(low, high - low)
        low = high


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n+1 indices of the rows' first words."""
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    inside = ~space[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes with one space after each, and the n+1 places where they begin."""
    room = np.concatenate([[0], np.cumsum(ends - starts + 1)]).astype(np.int64)
    out = np.full(int(room[-1]), 32, np.uint8)
    length = ends - starts
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(room[:-1], length) + inside] = data[np.repeat(starts, length) + inside]
    return out, room


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values that spreads every bit (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hash (modulo 2**64, odd ``base``) of values[start:end] for every span.

    Prefix sums of value * base**position give any span by one difference; multiplying by the
    inverse of base**start makes it independent of the position.
    """
    up = powers(base, len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=prefix[1:])
    down = powers(pow(base, -1, 2**64), len(values) + 1)
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 2**64, 256, np.uint64)
    base = int(rng.integers(0, 2**63)) * 2 + 1
    out = np.empty(len(starts), np.uint64)
    step = 200_000  # words; bounds the arrays of one value per byte
    for i in range(0, len(starts), step):
        a, b = starts[i : i + step], ends[i : i + step]
        piece = table[data[a[0] : b[-1]]]
        out[i : i + step] = span_hashes(piece, a - a[0], b - a[0], base)
    return mixed(out ^ (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, first: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``size`` words inside one row, and the index of its first word."""
    counts = np.diff(first)
    full = np.maximum(counts - size + 1, 0)
    total = int(full.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(total) - np.repeat(np.cumsum(full) - full, full) + np.repeat(first[:-1], full)
    base = int(np.random.default_rng(seed + 1).integers(0, 2**63)) * 2 + 1
    return span_hashes(words, at, at + size, base), at
