"""MinHash signatures: one vectorised function over Arrow batches of text."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from kindred.functions.text import EMPTY_SHINGLE

PRIME = 2**31 - 1
BASE = 1_000_003
# Shingles hashed at a time, so that a long text needs no large matrix.
CHUNK = 512
# Pairs of signatures compared at a time.
PAIRS = 512


def hash_family(n_hashes: int, seed: int = 42) -> list[tuple[int, int]]:
    """Coefficients (a, b) of ``n_hashes`` functions ``(a*x + b) mod PRIME``."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n_hashes)]


def place_values(k: int) -> list[int]:
    """Weight of each of a shingle's k characters in its base hash."""
    return [pow(BASE, k - 1 - j, PRIME) for j in range(k)]


def _base_hashes(text: str, k: int) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    n = len(points) - k + 1
    total = np.zeros(n, dtype=np.uint64)
    for j, weight in enumerate(place_values(k)):
        total += points[j : j + n] * np.uint64(weight)
    return total % np.uint64(PRIME)


def fixed_point(family: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """``(a / PRIME, b / PRIME)`` of each function, as fractions of 2^64.

    With them ``a*x + b`` wraps at 2^64 where the hash wraps at PRIME. For x below 2^31 the product falls
    short by less than half of 1/PRIME; the half added to b keeps the value within the step of its hash.
    """
    a = [(f[0] << 64) // PRIME for f in family]
    b = [((f[1] << 64) // PRIME + (1 << 32)) % (1 << 64) for f in family]
    return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)


def _minima(base: np.ndarray, a: np.ndarray, b: np.ndarray, work: np.ndarray) -> np.ndarray:
    """Least hash per function of ``fixed_point``; ``work`` is reused, as a fresh matrix costs more than the sums.

    Fractions are in the order of their hashes, so only the least one is turned into its hash.
    """
    lowest = np.full(len(a), 2**64 - 1, dtype=np.uint64)
    for start in range(0, len(base), CHUNK):
        part = base[start : start + CHUNK, None]
        h = work[: len(part)]
        np.multiply(part, a, out=h)
        np.add(h, b, out=h)
        np.minimum(lowest, h.min(axis=0), out=lowest)
    # lowest * PRIME / 2^64, without a product of more than 64 bits.
    return (lowest - (lowest >> np.uint64(31))) >> np.uint64(33)


def minhash_signature(
    text: Column,
    n_hashes: int = 200,
    k: int = 8,
    drop_last: bool = False,
    keep_empty: bool = False,
    seed: int = 42,
) -> Column:
    """Per hash function, the least hash over the text's k-character shingles.

    The least value over all shingles is that over the distinct ones, so no set
    is built. Texts without a shingle give an empty array, or with ``keep_empty``
    the signature of one sentinel shingle.
    """
    family = hash_family(n_hashes, seed)

    @arrow_udf("array<int>")
    def signature(texts: pa.Array) -> pa.Array:
        a, b = fixed_point(family)
        work = np.empty((CHUNK, n_hashes), dtype=np.uint64)
        rows = []
        for value in texts:
            document = value.as_py() or ""
            if drop_last:
                document = document[:-1]
            if len(document) >= k:
                rows.append(_minima(_base_hashes(document, k), a, b, work))
            elif keep_empty:
                rows.append(_minima(_base_hashes(EMPTY_SHINGLE, len(EMPTY_SHINGLE)), a, b, work))
            else:
                rows.append(np.empty(0, dtype=np.uint64))
        offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows], dtype=np.int64)])
        values = np.concatenate(rows) if rows else np.empty(0, dtype=np.uint64)
        return pa.ListArray.from_arrays(
            pa.array(offsets, type=pa.int32()), pa.array(values.astype(np.int32))
        )

    return signature(text)


def compared(a: Column, b: Column, r: int, n_bands: int) -> Column:
    """What two signatures of one length have in common, as ``(n_shared, dot, is_candidate)``.

    ``n_shared`` are the distinct values in both, ``dot`` the inner product, ``is_candidate`` whether any of the
    first ``n_bands`` bands of r values agrees.
    """

    @arrow_udf("struct<n_shared: int, dot: double, is_candidate: boolean>")
    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        shared, dots, same = [np.empty(0, np.int32)], [np.empty(0)], [np.empty(0, bool)]
        for start in range(0, len(left), PAIRS):
            x, y = (_matrix(side.slice(start, PAIRS)) for side in (left, right))
            dots.append(np.einsum("ij,ij->i", x.astype(np.float64), y.astype(np.float64)))
            bands = (x == y)[:, : n_bands * r].reshape(len(x), n_bands, r)
            same.append(bands.all(axis=2).any(axis=1))
            x.sort(axis=1)
            y.sort(axis=1)
            both = np.concatenate([x, y], axis=1)
            both.sort(axis=1)
            shared.append((_n_distinct(x) + _n_distinct(y) - _n_distinct(both)).astype(np.int32))
        columns = [pa.array(np.concatenate(part)) for part in (shared, dots, same)]
        return pa.StructArray.from_arrays(columns, ["n_shared", "dot", "is_candidate"])

    return compare(a, b)


def _matrix(signatures: pa.Array) -> np.ndarray:
    """Signatures of one length as rows of a matrix of its own."""
    return signatures.flatten().to_numpy(zero_copy_only=False).reshape(len(signatures), -1).copy()


def _n_distinct(rows: np.ndarray) -> np.ndarray:
    """Distinct values of each sorted row."""
    return 1 + np.count_nonzero(np.diff(rows, axis=1), axis=1)
