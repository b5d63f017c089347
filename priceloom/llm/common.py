"""Helpers that the operators share: durable intermediate tables, Arrow batches, vectorised hashing."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from priceloom.sources.rooms import clean, new_path, shared_dir  # noqa: F401

# Arrow's own pool keeps what it has freed; the system's gives it back.
pa.set_memory_pool(pa.system_memory_pool())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it again, so that a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Python strings of a text column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None


def _release() -> None:
    """Give freed memory back to the system, so that idle and reused workers stay small."""
    if _trim:
        _trim(0)


#: What operators remember in a worker from task to task.  Workers are reused, so each would go on holding what every operator left there.
remembered: list[dict] = []


def slices(batches, most_bytes: int = 2 << 20, most_rows: int = 4096, remember: bool = False):
    """Cut record batches so that a slice holds about ``most_bytes`` at most (one row at least), which bounds a worker's memory.

    What other operators ``remembered`` in this worker goes first, unless ``remember``; powers for hashes go with the last slice.
    """
    if not remember:
        for held in remembered:
            held.clear()
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        step = max(1, min(most_rows, int(n * most_bytes / max(1, b.nbytes))))
        for i in range(0, n, step):
            yield b.slice(i, min(step, n - i))
        _release()
    _powers.clear()
    _residues.clear()
    _release()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), vectorised."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd multiplier and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and doubled on demand."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled = 1
        with np.errstate(over="ignore"):
            while filled < size:
                have[filled : 2 * filled] = have[:filled] * np.uint64(pow(base, filled, 1 << 64))
                filled *= 2
        _powers[base] = have
    return have[:n]


class RangeHash:
    """Polynomial hashes modulo 2**64 of any byte ranges of a buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=self.sums[1:])
        self.inverse = powers(BASE_INVERSE, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])


#: Two primes, and for each a base of polynomial hashes; unlike powers of two, prime moduli leave structured strings no common collisions.
_PRIMES = ((2**31 - 1, 1_103_515_245), (2**31 - 19, 1_664_525_001))
_residues: dict[tuple[int, int], np.ndarray] = {}


def _powers_modulo(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo ``prime`` (under 2**31); kept and doubled on demand."""
    have = _residues.get((base, prime))
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        filled = 1
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * np.uint64(pow(base, filled, prime)) % np.uint64(prime)
            filled *= 2
        _residues[base, prime] = have
    return have[:n]


class PrimeHash:
    """62-bit polynomial hashes of byte ranges of a buffer, modulo two primes, mixed to 64 bits."""

    def __init__(self, data: np.ndarray):
        n, wide = len(data), data.astype(np.uint64) + np.uint64(1)
        self.parts = []
        for prime, base in _PRIMES:
            terms = wide * _powers_modulo(base, prime, n)
            if n > 1 << 23:  # sums of unreduced terms would pass 2**64
                terms %= np.uint64(prime)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.parts.append((np.uint64(prime), sums, _powers_modulo(pow(base, -1, prime), prime, n + 1)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        (p, a, inverse), (q, b, other) = self.parts
        high = (a[end] - a[start]) % p * inverse[start] % p
        return mix64(high << np.uint64(32) | (b[end] - b[start]) % q * other[start] % q)
