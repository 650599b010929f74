"""Hashes of words, spans and shingles of many texts at once, in NumPy over Arrow's own buffers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: An odd multiplier modulo 2^64 and its inverse; the hash of bytes b0..bn is the sum of VALUE[bi] * BASE^i, mixed.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes that are hashed together, and bytes of texts that are handled together, so that arrays stay small.
BLOCK, LOT = (1 << 18) - 1, 1 << 20

_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(by)
    return x ^ (x >> np.uint64(31))


#: A value for each byte, from the mixer.
VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))

#: Odd factors of the words of a shingle, and a term for sequences that are shorter than one.
PLACE, SHORT = mix(np.arange(2001, 2065, dtype=np.uint64)) | np.uint64(1), mix(np.array([2100], np.uint64))[0]

#: ASCII white space, and ASCII letters in lower case.
SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and INVERSE^i for i below n; kept, and grown by doubling."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]).cumprod() for b in (BASE, INVERSE)]
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for many spans; equal spans have equal hashes wherever they stand.

    Spans in order, none within another, are hashed BLOCK bytes at a time; one that is longer by BLAKE2b.
    """
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a > BLOCK:
            out[i] = int.from_bytes(hashlib.blake2b(data[a:b].tobytes(), digest_size=8).digest(), "little")
        else:
            up, down = _powers(b - a + 1)
            held = VALUE[data[a:b]]
            held *= up[: b - a]
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(held, out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, edges): the column's texts lie between neighbouring edges of data, which isn't copied; null is empty."""
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, at, held = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    edges = np.frombuffer(at, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(held, np.uint8) if held else np.empty(0, np.uint8), edges


def lots(column: pa.Array, most: int = LOT) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, after, data, edges): texts of about `most` bytes together, or one longer text; edges start at 0."""
    data, edges = text_bytes(column)
    a = 0
    while a < len(edges) - 1:
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + most, "right")) - 1)
        yield a, b, data[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
        a = b


def word_spans(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words between white space; none runs over an edge between texts."""
    space = SPACE[data]
    first, last = ~space, ~space
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] = ~space[inner]
    last[inner - 1] = ~space[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): of each text's shingles in order, from the hashes of its words; a shorter text has one, or none."""
    firsts = np.cumsum(counts) - counts
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out = np.empty(int(sizes.sum()), np.uint64)
    m = len(words) - width + 1
    if m > 0:
        joined = words[:m] * PLACE[0]
        for j in range(1, width):
            joined += words[j : j + m] * PLACE[j]
        left = np.repeat(firsts + counts, counts) - np.arange(len(words))
        out[np.repeat(counts >= width, sizes)] = mix(joined[left[:m] >= width])
    place = np.cumsum(sizes) - sizes
    for k in range(1, width):
        at = np.flatnonzero(counts == k)
        if len(at):
            joined = np.full(len(at), SHORT * np.uint64(k))
            for j in range(k):
                joined += words[firsts[at] + j] * PLACE[j]
            out[place[at]] = mix(joined)
    return out, sizes


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, after, hashes, counts): the sorted distinct shingles of texts, one after the other, A-Z in lower case."""
    for a, b, data, edges in lots(column):
        data = LOWER[data]
        starts, ends = word_spans(data, edges)
        flat, sizes = shingles(span_hashes(data, starts, ends), np.diff(np.searchsorted(starts, edges)), width)
        stops = np.cumsum(sizes)
        for i, j in zip((stops - sizes).tolist(), stops.tolist(), strict=True):
            flat[i:j].sort()
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        new[(stops - sizes)[sizes > 0]] = True
        seen = np.concatenate([[0], np.cumsum(new)])
        yield a, b, flat[new], seen[stops] - seen[stops - sizes]
