"""Vectorised hashing of words and word n-grams over many texts at once (NumPy, byte level)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multipliers and their inverses modulo 2**64.
BYTE, GRAM = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """For each range of ``data`` the polynomial sum of its values, the same wherever the range lies."""
    n = len(data)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(data * powers(base, n), out=total[1:])
    return (total[ends] - total[starts]) * powers(pow(base, -1, 1 << 64), n + 1)[starts]


class Words:
    """The words of a few texts: byte offsets, 64-bit hashes, and for each text its range of words."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts)
        raw = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            raw = LOWER[raw]
        self.raw = raw
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        full = np.zeros(len(raw) + 2, dtype=np.int8)
        full[1:-1] = ~BLANK[raw]
        step = np.diff(full)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.lo = np.searchsorted(self.starts, self.first)
        self.hi = np.searchsorted(self.starts, self.first + sizes)
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            h = ranges(self.raw.astype(U) + U(1), self.starts, self.ends, BYTE)
            self._hash = mix(h + (self.ends - self.starts).astype(U) * U(GRAM))
        return self._hash

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words that begin at each word; only those within one text are meaningful."""
        h = self.hash
        if len(h) < n:
            return np.zeros(0, dtype=U)
        at = np.arange(len(h) - n + 1)
        return mix(ranges(h, at, at + n, GRAM))


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """Cuts a batch into runs of rows of about ``most`` bytes of text: (first row, texts). A longer text stands alone; null is empty."""
    run, size, at = [], 0, 0
    for i, t in enumerate(batch.column(column).cast(pa.binary())):
        t = t.as_py() or b""
        if run and size + len(t) > most:
            yield at, run
            run, size, at = [], 0, i
        run.append(t)
        size += len(t)
    if run:
        yield at, run


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(values, type=kind))
