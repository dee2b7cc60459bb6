"""Array kernels over the texts of one Arrow batch, without a Python loop over words or bytes.

A column of texts is taken as one flat array of UTF-8 bytes with start and end per row (null: empty).
Strings are hashed to 64 bits from two polynomials over the bytes, by prefix sums, so the hash of any
span is a few look-ups. One polynomial is modulo 2^64; alone it would be equal for certain strings of 2^10 bytes and more whatever its base
(those of Thue and Morse), so another one modulo the prime 2^31 - 1 goes with it. The hashes do not depend on the process, the batch or the position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Base of the polynomial hash and odd multipliers of the mixers: any odd 64-bit numbers do.
BASE = 0x9E3779B97F4A7C15
PRIME = 2**31 - 1
PRIME_BASE = 1_583_458_089
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
TOP = np.iinfo(np.uint64).max

#: Bytes handled at a time: the working arrays take some 60 times as much.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

_TABLES: dict[str, np.ndarray] = {}


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts take at most ``limit`` bytes (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for row, size in enumerate(sizes):
        if total + size > limit and row > first:
            yield batch.slice(first, row - first)
            first, total = row, 0
        total += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all rows, and where each row starts and ends."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]: offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def _powers(name: str, base: int, n: int) -> np.ndarray:
    table = _TABLES.get(name)
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        table = _TABLES[name] = np.multiply.accumulate(table)
    return table[:n]


def _prime_powers(name: str, base: int, n: int) -> np.ndarray:
    """Powers modulo the prime, by doubling."""
    table = _TABLES.get(name)
    if table is None or len(table) < n:
        table, step = np.ones(1, dtype=np.uint64), base
        while len(table) < max(n, SLICE_BYTES + 1):
            table = np.concatenate([table, _modulo(table * np.uint64(step))])
            step = step * step % PRIME
        _TABLES[name] = table
    return table[:n]


def _modulo(x: np.ndarray) -> np.ndarray:
    """Remainders by 2^31 - 1."""
    p, bits = np.uint64(PRIME), np.uint64(31)
    for _ in range(2):
        x = (x & p) + (x >> bits)
    x = (x & p) + (x >> bits)
    return np.where(x == p, np.uint64(0), x)


def _inverse(base: int) -> int:
    x = base
    for _ in range(6):
        x = x * (2 - base * x) % 2**64
    return x


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values; one-to-one for a given seed."""
    x = x + np.uint64((seed * BASE + 1) % 2**64)
    x ^= x >> np.uint64(31)
    x *= MIX_1
    x ^= x >> np.uint64(29)
    x *= MIX_2
    x ^= x >> np.uint64(32)
    return x


class SpanHash:
    """64-bit hashes of spans ``[start, end)`` of ``data``."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        symbols = data.astype(np.uint64) + np.uint64(1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * _powers("up", BASE, n), out=self.sums[1:])
        self.down = _powers("down", _inverse(BASE), n + 1)
        terms = symbols * _prime_powers("prime-up", PRIME_BASE, n)
        # below 2^32 each, so the sum of 2^32 of them fits
        terms = (terms & np.uint64(PRIME)) + (terms >> np.uint64(31))
        self.prime_sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.prime_sums[1:])
        self.prime_down = _prime_powers("prime-down", pow(PRIME_BASE, -1, PRIME), n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        whole = (self.sums[end] - self.sums[start]) * self.down[start]
        rest = _modulo(_modulo(self.prime_sums[end] - self.prime_sums[start]) * self.prime_down[start])
        return whole ^ mix(rest, 5)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end))


def rows_of(positions: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Row that holds each byte position."""
    return np.searchsorted(ends, positions, side="right")


def words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not ASCII white space."""
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = ends > starts
    first[starts[full]] = solid[starts[full]]
    last[ends[full] - 1] = solid[ends[full] - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, rows_of(start, ends)


def shingles(word_hash: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word of every run of ``size`` words of a row, without runs across rows."""
    n = len(word_hash) - size + 1
    if n <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty
    first = np.flatnonzero(row[:n] == row[size - 1:])
    value = np.zeros(len(first), dtype=np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(3) + word_hash[first + k], k + 1)
    return value, row[first], first


def per_row(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum of non-negative whole numbers per row."""
    return np.bincount(row, weights=values, minlength=n_rows).astype(np.int64)


def slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values (two running minima per block of ``width``)."""
    n = len(x)
    padded = np.full(-(-n // width) * width, TOP, dtype=np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1: n])


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[0] .. start[0] + size[0] - 1``, then the next run, in one array."""
    total = np.cumsum(size)
    at = np.arange(total[-1] if len(total) else 0)
    return at + np.repeat(start - (total - size), size)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and their number per row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
