"""Words and word shingles of whole texts as numpy arrays, straight from Arrow buffers.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters, A-Z
lower-cased. Arrays are built for slices of a few megabytes of text, so that memory follows
the longest single text and not the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
U = np.uint64
IN_WORD = np.zeros(256, bool)
IN_WORD[128:] = IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += U(32)
_powers: dict[int, np.ndarray] = {}


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array end to end, and its n + 1 offsets; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, ends, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(ends, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batches: Iterable[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most ``limit`` text bytes, or one row."""
    for batch in batches:
        _, off = buffer(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(off, off[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, and some more: the table doubles, so workers keep what their slices need."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        steps = np.full(1 << max(n, 1 << 12).bit_length(), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray,
                base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hashes of values[begin:end] for many spans at once."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[:len(values)], out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), len(values))
    return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, first byte, end byte) of every word."""
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    keep = IN_WORD[data]
    begin, end = keep.copy(), keep.copy()
    begin[1:] &= ~keep[:-1] | edge[1:-1]
    end[:-1] &= ~keep[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    text = np.searchsorted(off, begin, "right") - 1
    return span_hashes(LOWER[data] + U(1), begin, end), text, begin, end


def shingles(hashes: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every k-word shingle; a shorter text is one shingle."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.r_[True, text[1:] != text[:-1]]
    whole = np.zeros(n, bool)
    whole[:max(0, n - k + 1)] = text[:max(0, n - k + 1)] == text[k - 1:]
    at = np.flatnonzero(whole | first)
    out = np.zeros(len(at), np.uint64)
    if n >= k:                                            # all runs of k words, also across texts
        run = hashes[:n - k + 1].copy()
        for j in range(1, k):
            run = run * U(0xD6E8FEB86659FD93) + hashes[j:n - k + 1 + j]
        out[whole[at]] = run[whole[:n - k + 1]]
    short = at[~whole[at]]
    rest = np.zeros(len(short), np.uint64)
    for j in range(k):
        to = np.minimum(short + j, n - 1)
        inside = (short + j < n) & (text[to] == text[short])
        rest = rest * U(0xD6E8FEB86659FD93) + np.where(inside, hashes[to], U(0))
    out[~whole[at]] = rest
    return at, mix(out)


def counted(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, value) with their counts, ordered."""
    order = np.lexsort((value, group))
    group, value = group[order], value[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return group[at], value[at], np.diff(np.r_[at, len(group)])
