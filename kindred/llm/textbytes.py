"""Words and their hashes, taken from whole Arrow columns at a time.

Texts are worked on as UTF-8 bytes. Whole documents of up to ``PIECE`` bytes
together are one step; a longer document is cut at white space into pieces of about
that size, so memory follows the longest document's words and not its bytes times eight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    n = len(column)
    if not n or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups_of_documents(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of documents that together hold at most ``limit`` bytes, or one longer document."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high
        low = high


def white_space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(WHITE_SPACE)] = True
    return table


def word_spans(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word; ``offsets`` begin at 0 within ``data``."""
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[lasts] = inside[lasts]
    starts = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, np.flatnonzero(ends) + 1, owner


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all others; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of white-space words, with A-Z taken as a-z.

    A word's hash is a polynomial over random numbers that stand for its bytes; all
    words of a step come from one running sum.
    """

    def __init__(self, seed: int = 11, lower: bool = True):
        random = np.random.default_rng(seed)
        self.blank = white_space_table()
        self.numbers = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.numbers[0x41:0x5B] = self.numbers[0x61:0x7B]
        self.base = int(random.integers(1, 2**61)) * 8 + 5
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        with np.errstate(over="ignore"):
            powers = np.full(n, self.base, np.uint64)
            powers[0] = 1
            self.powers = np.cumprod(powers, dtype=np.uint64)
            powers[1:] = pow(self.base, -1, 2**64)
            self.inverses = np.cumprod(powers, dtype=np.uint64)

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) > len(self.powers):
            self._grow(max(len(data), 2 * len(self.powers)))
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=running[1:])
        return mix64((running[ends] - running[starts]) * self.inverses[starts])

    def pieces(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """A long text in parts that end at white space."""
        low = 0
        while low < len(data):
            high = min(low + PIECE, len(data))
            if high < len(data):
                step = high
                while step < len(data) and not self.blank[data[step]]:
                    later = np.flatnonzero(self.blank[data[step : step + PIECE]])
                    step = step + int(later[0]) if len(later) else min(step + PIECE, len(data))
                high = step
            yield data[low:high]
            low = high

    def words(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(low, high, hashes, owner)``: the words of documents low to high, in order."""
        data, offsets = text_bytes(column)
        for low, high in groups_of_documents(offsets, PIECE):
            part = data[offsets[low] : offsets[high]]
            if len(part) <= PIECE:
                starts, ends, owner = word_spans(part, offsets[low : high + 1] - offsets[low], self.blank)
                yield low, high, self._hashes(part, starts, ends), owner
                continue
            found = []
            for piece in self.pieces(part):
                starts, ends, _ = word_spans(piece, np.array([0, len(piece)]), self.blank)
                found.append(self._hashes(piece, starts, ends))
            hashes = np.concatenate(found)
            yield low, high, hashes, np.zeros(len(hashes), np.int64)


def shingles(
    hashes: np.ndarray, owner: np.ndarray, n_docs: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle hash, owner)`` of every run of ``width`` words of one document.

    A document of fewer words, but not none, is one shingle of all its words.
    """
    factors = mix64(np.arange(1, width + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    runs = max(len(hashes) - width + 1, 0)
    total = np.zeros(runs, np.uint64)
    for k in range(width):
        total += hashes[k : k + runs] * factors[k]
    whole = owner[:runs] == owner[width - 1 : width - 1 + runs]
    found, owners = total[whole], owner[:runs][whole]
    counts = np.bincount(owner, minlength=n_docs)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(owner, short)
        extra = counts[short].astype(np.uint64) * factors[width]
        for k in range(width - 1):
            there = counts[short] > k
            extra[there] += hashes[first[there] + k] * factors[k]
        found = np.concatenate([found, extra])
        owners = np.concatenate([owners, short])
    return mix64(found), owners
