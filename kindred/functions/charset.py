"""Character sets as words of bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Words of 64 bits for the most frequent characters; the others are a list of numbers.
WORDS = 4
BITS = 64
# Pairs of sets compared together, few enough for the words of all to stay in the cache.
TILE = 1 << 17
# Columns of a set: its size, its words and its list.
COLUMNS = ("size", *[f"w{k}" for k in range(WORDS)], "rest")

Side = Callable[[str], Column]


def characters(text: Column) -> Column:
    """The distinct characters of a text in order, as one string; a null text has none."""

    @arrow_udf("string")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array(["".join(sorted(set(t.as_py() or ""))) for t in texts], pa.string())

    return distinct(text)


def word_of(number: Column, k: int) -> Column:
    """The bit of a number in word k, null if it lies elsewhere; to be put together by ``bit_or``."""
    inside = (number >= k * BITS) & (number < (k + 1) * BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (number % BITS).cast("int"))
    return F.when(inside, bit)


def overlap(a: Side, b: Side) -> Column:
    """Number of characters that two sets share."""
    words = [F.bit_count(a(f"w{k}").bitwiseAND(b(f"w{k}"))) for k in range(WORDS)]
    # Most sets have no list; that of two is looked at only where both have one.
    both = (F.size(a("rest")) > 0) & (F.size(b("rest")) > 0)
    listed = F.when(both, F.size(F.array_intersect(a("rest"), b("rest")))).otherwise(0)
    return reduce(lambda x, y: x + y, words) + listed


def similarity(a: Side, b: Side) -> Column:
    """Jaccard similarity of two sets; 0 when both are empty."""
    both = overlap(a, b)
    return F.coalesce(F.try_divide(both, a("size") + b("size") - both), F.lit(0.0))


class Words:
    """The set columns of a table as arrays: words of bits, with further words for listed numbers that sets share."""

    def __init__(self, table: pa.Table):
        self.size = table["size"].to_numpy().astype(np.int64)
        self.words = [table[f"w{k}"].to_numpy().view(np.uint64) for k in range(WORDS)]
        self.words = [word for word in self.words if word.any()]
        self.n_frequent = len(self.words)
        rest = table["rest"].combine_chunks()
        offsets = rest.offsets.to_numpy()
        self.listed = np.diff(offsets).astype(np.int64)
        listed = rest.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        rows = np.repeat(np.arange(len(rest)), np.diff(offsets))
        numbers, code, n = np.unique(listed, return_inverse=True, return_counts=True)
        place = np.cumsum(n > 1) - 1
        in_two = n[code] > 1
        rows, place = rows[in_two], place[code[in_two]]
        for k in range(-(-int((n > 1).sum()) // BITS)):
            here = place // BITS == k
            word = np.zeros(len(rest), np.uint64)
            np.bitwise_or.at(word, rows[here], np.uint64(1) << (place[here] % BITS).astype(np.uint64))
            self.words.append(word)

    def overlap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Characters shared by sets i and j; the two may be of any shapes that fit."""
        both = np.zeros(np.broadcast_shapes(i.shape, j.shape), np.int32)
        for word in self.words:
            both += np.bitwise_count(word[i] & word[j])
        return both

    def similarity(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        both = self.overlap(i, j)
        whole = self.size[i] + self.size[j] - both
        return np.divide(both, whole, out=np.zeros(both.shape), where=whole > 0)

    def alike(
        self, left: np.ndarray, right: np.ndarray, same: bool, threshold: float
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows (i, j) of both sides whose similarity is at least ``threshold``, and that similarity.

        Sides are in order of size; where both are the ``same``, each pair comes once. Sets are compared tile by
        tile by their frequent characters; lists only where these and the lengths of both lists allow the threshold.
        """
        sizes, listed = self.size[right], self.listed[right]
        words = [word[right] for word in self.words[: self.n_frequent]]
        # A byte holds the overlap of three words.
        kind = np.uint8 if len(words) < 4 else np.uint16
        of_left = self.size[left]
        firsts = np.flatnonzero(np.diff(of_left, prepend=-1))
        for first, last in zip(firsts, [*firsts[1:], len(left)], strict=True):
            size = int(of_left[first])
            low = np.searchsorted(sizes, size * threshold - 1e-6)
            high = np.searchsorted(sizes, size / threshold + 1e-6, "right")
            least = np.ceil((size + sizes) * (threshold / (1 + threshold)) - 1e-6)
            step = max(1, TILE // max(1, high - low))
            for start in range(first, last, step):
                i = left[start : min(start + step, last)]
                # In one block, partners come after the first row of the tile.
                at = slice(max(low, start + 1) if same else low, high)
                if at.start >= high:
                    break
                both = np.zeros((len(i), high - at.start), kind)
                for mine, other in zip(self.words, words, strict=False):
                    both += np.bitwise_count(mine[i][:, None] & other[at])
                if self.listed[i].any() and listed[at].any():
                    more = np.minimum(self.listed[i][:, None], listed[at])
                    hit = np.flatnonzero(both + more >= least[at])
                else:
                    more = None
                    hit = np.flatnonzero(both >= np.minimum(least[at], np.iinfo(kind).max).astype(kind))
                a, b = hit // both.shape[1], hit % both.shape[1]
                if same:
                    later = at.start + b > start + a
                    a, b, hit = a[later], b[later], hit[later]
                a, b = i[a], right[at][b]
                shared = both.ravel()[hit].astype(np.int64) if more is None else self.overlap(a, b)
                sim = shared / (self.size[a] + self.size[b] - shared)
                enough = sim >= threshold
                yield a[enough], b[enough], sim[enough]


def product_sum(a: np.ndarray, b: np.ndarray) -> int:
    """Sum of products of counts, however large."""
    if len(a) and float(a.max()) * float(b.max()) * len(a) >= 2.0**62:
        return int((a.astype(object) * b.astype(object)).sum())
    return int((a * b).sum())
