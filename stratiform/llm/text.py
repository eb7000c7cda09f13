"""Texts of an Arrow column as flat NumPy arrays: bytes, words, word windows.

All helpers work on one slice of a batch at a time, so their memory is bounded by
``SLICE_BYTES`` or by one text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 17

# The bytes that separate words, 0x20 and 0x09 to 0x0D.
BLANKS = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)

IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[list(BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row count, bytes, offsets)`` of consecutive rows holding about ``limit``
    bytes of UTF-8. NULL counts as the empty text."""
    texts = pc.cast(pc.fill_null(batch.column(column), ""), pa.large_string())
    if not len(texts):
        return
    _, raw, data = texts.buffers()
    offsets = np.frombuffer(raw, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end - row, flat[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, words per text)`` of the maximal runs of non-blank bytes; no word
    crosses from one text into the next."""
    solid = ~IS_BLANK[flat]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(flat))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def _random64(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class Hasher:
    """64-bit hashes of byte stretches by one prefix sum: every byte stands for a random odd
    number, weighted by a power of an odd base. Two hashers with other seeds are independent."""

    def __init__(self, seed: int):
        self.table = _random64(seed, 256)
        self.base = _random64(seed + 1, 1)[0]
        self.inverse = np.uint64(pow(int(self.base), -1, 2**64))
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << int(n - 1).bit_length()
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, self.base, np.uint64)]))
                self.inverses = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, self.inverse, np.uint64)]))

    def prefix(self, flat: np.ndarray) -> np.ndarray:
        self._grow(len(flat) + 1)
        out = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(self.table[flat] * self.powers[: len(flat)], out=out[1:])
        return out

    def of(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches whose starts and ends both rise; a block of bytes at a time, so
        that the powers needed stay few and everything fits the processor's cache."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            base = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
            prefix = self.prefix(flat[base : ends[to - 1]])
            s, e = starts[at:to] - base, ends[at:to] - base
            out[at:to] = mix((prefix[e] - prefix[s]) * self.inverses[s])
            at = to
        return out

    def grams(self, flat: np.ndarray, width: int) -> np.ndarray:
        """Hash of ``flat[i : i + width]`` for every i that has so many bytes."""
        n = max(0, len(flat) - width + 1)
        out = np.empty(n, np.uint64)
        for at in range(0, n, BLOCK_BYTES):
            to = min(n, at + BLOCK_BYTES)
            prefix = self.prefix(flat[at : to + width - 1])
            out[at:to] = mix((prefix[width:] - prefix[:-width]) * self.inverses[: to - at])
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def windows(values: np.ndarray, width: int, seed: int = 11) -> np.ndarray:
    """Hash of ``values[i : i + width]`` for every i that has so many values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    weights = _random64(seed, width)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += values[k : k + n] * weights[k]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``values[i : i + width]`` for every i that has so many values, from running
    minima of blocks in both directions."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, values.dtype)
    grid = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    grid[: len(values)] = values
    grid = grid.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches put one after another, and their offsets."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.ones(offsets[-1], np.int64) if offsets[-1] else np.zeros(0, np.int64)
    full = np.flatnonzero(lengths)
    if len(full):
        at, begin, size = offsets[full], starts[full], lengths[full]
        index[at[0]] = begin[0]
        index[at[1:]] = begin[1:] - (begin[:-1] + size[:-1]) + 1
        np.cumsum(index, out=index)
    return flat[index], offsets


def binary_column(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The stretches as an Arrow column of bytes, without a copy for each."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])
