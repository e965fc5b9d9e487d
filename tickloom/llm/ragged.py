"""Whole texts as flat byte arrays: words, their hashes, and pieces of bounded size.

A batch of texts becomes one byte array and the offsets of its rows. Words are found
and hashed for all rows at once; work per word or per distinct word follows from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. A longer text is a piece of its own.
PIECE_BYTES = 1 << 20

U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(32))) * U64(_BASE)
    x = (x ^ (x >> U64(29))) * U64(_MULTIPLIER)
    return x ^ (x >> U64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, U64), np.full(n, inverse, U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hasher:
    """Hashes of byte ranges through prefix sums, for one task."""

    def __init__(self, fold_case: bool = True):
        bytes_ = np.arange(256, dtype=U64)
        if fold_case:
            bytes_[65:91] += U64(32)
        self.values = mix(bytes_ + U64(1))
        self.up, self.down = _powers(1 << 16)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.up, self.down = _powers(1 << int(len(data)).bit_length())
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES, most: int = 4096
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds ``limit`` bytes, or one row; ``most`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        totals = np.cumsum(sizes, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = totals[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(totals, before + limit, side="right")))
            last = min(last, first + most)
            yield batch.slice(first, last - first)
            first = last


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, null as empty, and the offsets of the rows."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


#: The bytes between words: space, tab, line feed, vertical tab, form feed, return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs of ``inside``; none crosses a row."""
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words: runs without the bytes of ``BLANK``."""
    return runs(~BLANK[data], offsets)


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given ranges one after the other, and their offsets."""
    lengths = ends - starts
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return data[at], offsets


def strings(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.string()) -> pa.Array:
    """An Arrow column of the given ranges."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.large_string()).cast(kind)


class Remembered:
    """Values by 64-bit key, as sorted arrays; starts anew beyond ``most`` keys."""

    def __init__(self, most: int, shape: tuple[int, ...] = (), kind: type = np.int64):
        self.most, self.keys, self.values = most, np.zeros(0, U64), np.zeros((0, *shape), kind)

    def get(self, keys: np.ndarray, compute) -> np.ndarray:
        """The values of distinct ``keys``; ``compute(positions)`` gives those not yet known."""
        at = np.searchsorted(self.keys, keys)
        seen = np.zeros(len(keys), bool)
        if len(self.keys):
            seen = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        values = np.zeros((len(keys), *self.values.shape[1:]), self.values.dtype)
        values[seen] = self.values[at[seen]]
        fresh = np.flatnonzero(~seen)
        if len(fresh):
            values[fresh] = compute(fresh)
            if len(self.keys) + len(fresh) > self.most:
                self.keys, self.values = self.keys[:0], self.values[:0]
                at = np.zeros(len(keys), np.int64)
            order = np.argsort(keys[fresh], kind="stable")
            place = at[fresh][order]
            self.keys = np.insert(self.keys, place, keys[fresh][order])
            self.values = np.insert(self.values, place, values[fresh][order], axis=0)
        return values


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Rows that agree in ``names`` together; the input has them next to each other."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        change = np.zeros(table.num_rows - 1, bool)
        for name in names:
            values = table.column(name).to_numpy()
            change |= values[1:] != values[:-1]
        borders = np.concatenate(([0], np.flatnonzero(change) + 1))
        table = table.combine_chunks()
        for lo, hi in zip(borders[:-1], borders[1:]):
            yield table.slice(lo, hi - lo)
        rest = table.slice(borders[-1])
    if rest is not None and rest.num_rows:
        yield rest
