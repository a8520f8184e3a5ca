"""Whole Arrow string columns as flat byte arrays, with word spans and hashes.

Everything here works on a batch at once with numpy.  Hashes have 64 bits and
depend on the bytes alone, so any task on any machine gives the same value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, and the n + 1 places where its rows begin; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return body[starts[0] : starts[-1]], starts - starts[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut between rows to about `most` bytes of text each, so that working arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        body, starts = flat(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), body[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
            first = last
    pa.default_memory_pool().release_unused()  # workers live longer than their tasks


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True within each row, and the n + 1 places where rows begin among them."""
    if not len(inside):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(starts), np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[starts] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    begins = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return begins, ends, np.searchsorted(begins, starts)


def range_hashes(body: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range."""
    up, down = powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    sums[1:] = body
    sums[1:] += np.uint64(1)
    sums[1:] *= up[:-1]
    np.cumsum(sums[1:], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def words(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, and where each row's words begin."""
    begins, ends, firsts = spans(~BLANK[body], starts)
    return range_hashes(LOWER[body], begins, ends), firsts


def shingles(hashes: np.ndarray, firsts: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's sorted set of k-word shingles; a shorter row's words are one shingle, no words none."""
    n, counts = len(hashes), np.diff(firsts)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        rolled = mix(rolled + hashes[j : j + len(rolled)] + np.uint64(j + 1))
    out = []
    for first, count in zip(firsts[:-1], counts):
        if count >= k:
            out.append(np.unique(rolled[first : first + count - k + 1]))
        elif count:
            one = np.zeros(1, np.uint64)
            for j in range(count):
                one = mix(one + hashes[first + j] + np.uint64(j + 1))
            out.append(mix(one + np.uint64(1000 + count)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
