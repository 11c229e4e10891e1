"""Whole-text word arithmetic on Arrow buffers, shared by the text operators.

Texts arrive in tasks as Arrow string columns.  The helpers below work on the
UTF-8 bytes of small runs of documents (never more than ``CHUNK_BYTES`` unless
a single document is larger), so a task's memory follows its largest document
and not the size of its Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: bytes of words `[^\x20\x09-\x0D]+`: everything but space and tab to carriage return
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in text whose A-Z are lower-cased
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

#: lower-cases A-Z and leaves every other byte
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null counts as an empty text."""
    column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64)


def runs(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``(i, j)`` of at most ``most`` bytes, or of one row that is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, firsts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word never crosses a text start in ``firsts``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = table[data]
    cuts = firsts[(firsts > 0) & (firsts < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cuts] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For ascending word starts, the index of the text each word belongs to."""
    return np.searchsorted(offsets[1:], starts, side="right")


def per_text(owner: np.ndarray, n: int) -> np.ndarray:
    """``n + 1`` borders: words ``[b[i], b[i+1])`` belong to text ``i``."""
    return np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Sums:
    """Polynomial hashes of slices modulo 2**64, from one running sum.

    Slice ``[i, j)`` hashes to ``sum(v[t] * base**(t - i))``, mixed; equal
    slices have equal hashes wherever they stand.
    """

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.base = int(rng.integers(1 << 62)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.bytes = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))

    def over(self, values: np.ndarray) -> np.ndarray:
        """The running sum to hand to :meth:`slices`."""
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def slices(self, running: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix((running[j] - running[i]) * self.down[i] + (j - i).astype(np.uint64))
