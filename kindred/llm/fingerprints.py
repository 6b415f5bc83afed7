"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.textbytes import WordHasher, mix64, white_space_table, word_spans

# Cells of the smallest sketch. Two sketches whose difference does not come apart are tried again with
# four times as many cells, a stored one that does not come apart alone with twice as many.
CELLS = 15
GROWTH = 4
HASHES = 3
# Least number of cells a stored sketch has for each of its pieces.
CELLS_PER_PIECE = 1.5
# A stored cell: number of pieces, sum of their digests and sum of their checks, all modulo the type.
CELL = np.dtype([("count", "<u2"), ("keys", "<u8"), ("checks", "<u4")])
# A paragraph is cut after a word whose hash is divisible by this, so that an edit in a
# long one changes only the piece it falls in.
PIECE_WORDS = 4
GROUP_BYTES = 1 << 20
CHECK = np.uint64(0xC2B2AE3D27D4EB4F)


class ParagraphHasher:
    """64-bit digests of the paragraphs of texts, as pairs of text number and digest.

    A paragraph ends with its line; long ones are cut by content. The n-th copy of a paragraph
    in a text has a digest of its own, so repeats count.
    """

    def __init__(self) -> None:
        self.hasher = WordHasher(seed=47, lower=False)
        self.blank = white_space_table()

    def digests(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(t) for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        starts, ends, _ = word_spans(data, offsets, self.blank)
        words = self.hasher._hashes(data, starts, ends)
        cut = np.zeros(len(data) + 1, bool)
        cut[ends[words % np.uint64(PIECE_WORDS) == 0]] = True
        cut[np.flatnonzero(data == 0x0A) + 1] = True
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        first, last = bounds[:-1], bounds[1:]
        digest = self.hasher._hashes(data, first, last)
        owner = np.searchsorted(offsets, first, "right") - 1
        order = np.lexsort((digest, owner))
        owner, digest = owner[order], digest[order]
        fresh = np.r_[True, (owner[1:] != owner[:-1]) | (digest[1:] != digest[:-1])]
        begins = np.flatnonzero(fresh)
        copy = np.arange(len(digest)) - np.repeat(begins, np.diff(np.r_[begins, len(digest)]))
        return owner, mix64(digest + copy.astype(np.uint64) * CHECK)


def _places(key: np.ndarray, third: np.ndarray, base: np.ndarray, seed: int) -> list[np.ndarray]:
    """One cell of each third of a sketch."""
    found = []
    for k in range(HASHES):
        salt = np.uint64((0x9E3779B97F4A7C15 * (seed * HASHES + k + 1)) % 2**64)
        spread = mix64(key ^ salt) >> np.uint64(11)
        found.append(base + k * third + (spread % third.astype(np.uint64)).astype(np.int64))
    return found


def check_of(key: np.ndarray) -> np.ndarray:
    """32 bits that tell a single digest from a sum of several."""
    return (mix64(key ^ CHECK) >> np.uint64(32)).astype(np.uint32)


class Sketches:
    """Sketches of several sets in one array; each has ``thirds[i] * 3`` cells."""

    def __init__(self, thirds: np.ndarray, seed: int):
        self.thirds, self.seed = thirds, seed
        self.base = np.concatenate([[0], np.cumsum(thirds * HASHES)]).astype(np.int64)
        n = int(self.base[-1])
        self.count = np.zeros(n, np.int64)
        self.keys = np.zeros(n, np.uint64)
        self.checks = np.zeros(n, np.uint32)
        self.owner = np.repeat(np.arange(len(thirds)), thirds * HASHES)

    def add(self, owner: np.ndarray, key: np.ndarray, sign: np.ndarray | int) -> list[np.ndarray]:
        """Add digests, or take them off, and tell in which cells."""
        sign = np.broadcast_to(np.asarray(sign, np.int64), key.shape)
        signed = sign.astype(np.uint64)
        check = check_of(key)
        places = _places(key, self.thirds[owner], self.base[owner], self.seed)
        for place in places:
            np.add.at(self.count, place, sign)
            np.add.at(self.keys, place, key * signed)
            np.add.at(self.checks, place, check * sign.astype(np.uint32))
        return places

    def packed(self) -> np.ndarray:
        """All cells in the form in which they are stored."""
        cells = np.empty(len(self.count), CELL)
        cells["count"], cells["keys"], cells["checks"] = self.count, self.keys, self.checks
        return cells

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(owner, key, sign, whole)``: what each sketch holds, and whether it came apart."""
        owners, keys, signs = [], [], []
        look = np.arange(len(self.count))
        touched = np.zeros(len(self.count), bool)
        while len(look):
            count = self.count[look]
            single = look[np.abs(count) == 1]
            sign = self.count[single]
            key = self.keys[single] * sign.astype(np.uint64)
            pure = check_of(key) * sign.astype(np.uint32) == self.checks[single]
            owner, key, sign = self.owner[single[pure]], key[pure], sign[pure]
            if not len(key):
                break
            order = np.argsort(key ^ (owner.astype(np.uint64) * CHECK))
            owner, key, sign = owner[order], key[order], sign[order]
            once = np.r_[True, (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]
            owner, key, sign = owner[once], key[once], sign[once]
            for place in self.add(owner, key, -sign):
                touched[place] = True
            owners.append(owner)
            keys.append(key)
            signs.append(sign)
            look = np.flatnonzero(touched)
            touched[look] = False
        left = np.unique(self.owner[(self.count != 0) | (self.keys != 0) | (self.checks != 0)])
        whole = np.ones(len(self.thirds), bool)
        whole[left] = False
        if not keys:
            none = np.empty(0, np.int64)
            return none, none.astype(np.uint64), none, whole
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(signs), whole


def differences(
    n_pairs: int,
    left: tuple[np.ndarray, np.ndarray],
    right: tuple[np.ndarray, np.ndarray],
    cells: int = CELLS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, digest, side)`` that only one text of each pair has; side 1 left, -1 right.

    The sketches of both are subtracted and peeled; pairs that do not come apart are tried again
    with larger sketches and other hash functions.
    """
    open_pairs = np.arange(n_pairs)
    found_pair, found_key, found_side = [], [], []
    attempt = 0
    while len(open_pairs):
        number = np.full(n_pairs, -1)
        number[open_pairs] = np.arange(len(open_pairs))
        thirds = np.full(len(open_pairs), -(-cells // HASHES), np.int64)
        difference = Sketches(thirds, attempt)
        for (owner, key), sign in ((left, 1), (right, -1)):
            mine = number[owner] >= 0
            difference.add(number[owner[mine]], key[mine], sign)
        owner, key, side, whole = difference.peel()
        done = whole[owner]
        found_pair.append(open_pairs[owner[done]])
        found_key.append(key[done])
        found_side.append(side[done])
        open_pairs = open_pairs[~whole]
        cells *= GROWTH
        attempt += 1
    if not found_pair:
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none
    return np.concatenate(found_pair), np.concatenate(found_key), np.concatenate(found_side)


def likeness(n_left: np.ndarray, n_right: np.ndarray, n_different: np.ndarray) -> np.ndarray:
    """Shared paragraphs over all; two empty texts are alike."""
    either = n_left + n_right + n_different
    return np.where(either > 0, (n_left + n_right - n_different) / np.maximum(either, 1), 1.0)


def stored_cells(n: int, owner: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """Cells of each of ``n`` sets, as many as it takes for the sketch to come apart by itself.

    Their number is CELLS times a power of two, so that a larger sketch can be folded onto a smaller one.
    """
    totals = np.bincount(owner, minlength=n)
    rungs = np.ceil(np.log2(np.maximum(CELLS_PER_PIECE * totals / CELLS, 1))).astype(np.int64)
    cells: list[np.ndarray] = [np.empty(0, CELL)] * n
    left = np.arange(n)
    while len(left):
        number = np.full(n, -1)
        number[left] = np.arange(len(left))
        mine = number[owner] >= 0
        sketches = Sketches((CELLS // HASHES) << rungs[left], 0)
        sketches.add(number[owner[mine]], key[mine], 1)
        packed = sketches.packed()
        whole = sketches.peel()[3]
        for i in np.flatnonzero(whole):
            cells[left[i]] = packed[sketches.base[i] : sketches.base[i + 1]]
        left = left[~whole]
        rungs[left] += 1
    return cells


def folded(cells: np.ndarray, third: int) -> np.ndarray:
    """A sketch with fewer cells, ``third`` in each third, of the same set."""
    if len(cells) == third * HASHES:
        return cells
    less = np.empty(third * HASHES, CELL)
    for field in CELL.names:
        parts = cells[field].reshape(HASHES, -1, third)
        less[field] = parts.sum(axis=1, dtype=cells[field].dtype).ravel()
    return less


def subtracted(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> Sketches:
    """Differences of pairs of stored sketches, each at the size of its smaller one."""
    thirds = np.array([min(len(a), len(b)) // HASHES for a, b in zip(left, right)], np.int64)
    difference = Sketches(thirds, 0)
    one, other = (
        np.concatenate([folded(c, t) for c, t in zip(side, thirds)]) for side in (left, right)
    )
    difference.count = (one["count"] - other["count"]).astype(np.int16).astype(np.int64)
    difference.keys = one["keys"] - other["keys"]
    difference.checks = one["checks"] - other["checks"]
    return difference


def recovered(cells: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, digest)`` of all that stored sketches hold."""
    owner, key, _, whole = subtracted(cells, [np.zeros(len(c), CELL) for c in cells]).peel()
    if not whole.all():
        raise ValueError("a stored sketch does not come apart")
    return owner, key


def stored_differences(
    left: Sequence[np.ndarray], right: Sequence[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, digest, side)`` that only one of two stored sketches holds, from these alone.

    The two are subtracted and peeled. Where that fails, as for texts with little in common, larger sketches are
    made of the digests that each gives back, and subtracted in turn.
    """
    if not left:
        return differences(0, *[(np.empty(0, np.int64), np.empty(0, np.uint64))] * 2)
    pair, key, side, whole = subtracted(left, right).peel()
    again = np.flatnonzero(~whole)
    if not len(again):
        return pair, key, side
    done = whole[pair]
    sides = (recovered([cells[i] for i in again]) for cells in (left, right))
    smaller = max(min(len(left[i]), len(right[i])) for i in again)
    pair_2, key_2, side_2 = differences(len(again), *sides, cells=GROWTH * smaller)
    return (
        np.concatenate([pair[done], again[pair_2]]),
        np.concatenate([key[done], key_2]),
        np.concatenate([side[done], side_2]),
    )


def stored_likeness(
    totals_left: np.ndarray,
    left: Sequence[np.ndarray],
    totals_right: np.ndarray,
    right: Sequence[np.ndarray],
) -> np.ndarray:
    """Likeness of pairs of stored sketches with their numbers of pieces."""
    n_different = np.bincount(stored_differences(left, right)[0], minlength=len(left))
    return likeness(totals_left, totals_right, n_different)


def printed(totals: np.ndarray, cells: Sequence[np.ndarray]) -> list[str]:
    """Stored sketches as text: number of pieces, then the cells."""
    return [f"{n}:{base64.b64encode(c.tobytes()).decode()}" for n, c in zip(totals, cells)]


def printed_of(text: str) -> str:
    """The stored fingerprint of one text."""
    owner, key = ParagraphHasher().digests([text.encode()])
    return printed(np.array([len(key)]), stored_cells(1, owner, key))[0]


def read_sketch(stored: str) -> tuple[int, np.ndarray]:
    """Number of pieces and the cells of a stored fingerprint."""
    total, _, cells = stored.partition(":")
    return int(total), np.frombuffer(base64.b64decode(cells), CELL)


def differing_digests(one: str, other: str) -> list[tuple[int, int]]:
    """``(digest, side)`` that two stored fingerprints differ in; side 1 the first, -1 the other."""
    _, key, side = stored_differences([read_sketch(one)[1]], [read_sketch(other)[1]])
    return list(zip(key.tolist(), side.tolist()))


def fingerprint_likeness(one: str, other: str) -> float:
    """Likeness of two texts, from their stored fingerprints alone."""
    (n, a), (m, b) = read_sketch(one), read_sketch(other)
    return float(stored_likeness(np.array([n]), [a], np.array([m]), [b])[0])


def edited(text: str, following: str) -> str:
    """The last third of a text, replaced by as many first characters of the following one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compared(texts: Sequence[str]) -> list[list]:
    """Columns for each text but the last; the one after it follows it."""
    n = len(texts) - 1
    hasher = ParagraphHasher()
    raw_changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    sets = hasher.digests([t.encode() for t in texts]), hasher.digests(raw_changed)
    totals, totals_new = (np.bincount(owner, minlength=k) for (owner, _), k in zip(sets, (n + 1, n)))
    own, new = (stored_cells(k, *found) for found, k in zip(sets, (n + 1, n)))
    return [
        [len(t) for t in texts[:n]],
        [hashlib.sha256(t).hexdigest() for t in raw_changed],
        printed(totals[:n], own[:n]),
        printed(totals_new, new),
        stored_likeness(totals[:n], own[:n], totals_new, new).tolist(),
        stored_likeness(totals[:n], own[:n], totals[1:], own[1:]).tolist(),
    ]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _bounds_of_ranges(docs: DataFrame, n: int) -> np.ndarray:
    """Ids that cut the documents into about ``n`` even ranges."""
    shares = [k / n for k in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 20 * n)).first()[0] if shares else None
    return np.unique(np.array(found or [], np.int64))


def _range_of(ids: np.ndarray, missing: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of the range of each id, the largest ids first and null last."""
    place = len(bounds) - np.searchsorted(bounds, ids, "left")
    return np.where(missing, len(bounds), place)


def with_following(docs: DataFrame, n_ranges: int) -> DataFrame:
    """``(_range, _halo, doc_id, text)``: documents by descending id, cut into ranges.

    Every document goes to its range, and the first of a range goes also to the range before it as
    ``_halo``, so that each document and its follower meet without a sort in one task. Only
    the bounds and first ids of the ranges, as many as there are ranges, come to
    the driver.
    """
    bounds = _bounds_of_ranges(docs, n_ranges)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            place = _range_of(ids.fill_null(0).to_numpy(), missing, bounds)
            there, heads = np.unique(place), []
            for r in there:
                mine = ids.filter(pa.array(place == r))
                heads.append(pc.max(mine).as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array(there.astype(np.int64)), pa.array(heads, pa.int64())], names=["_range", "head"]
            )

    heads = {
        row["_range"]: row["head"]
        for row in docs.select("doc_id")
        .mapInArrow(numbered, "_range long, head long")
        .groupBy("_range")
        .agg(F.max("head").alias("head"))
        .collect()
    }
    order = sorted(heads)
    before = {order[k]: order[k - 1] for k in range(len(order))}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            missing = ids.is_null().to_numpy(zero_copy_only=False)
            plain = ids.fill_null(0).to_numpy()
            place = _range_of(plain, missing, bounds)
            copies = [
                i
                for r in np.unique(place)
                for i in np.flatnonzero(
                    (place == r) & (missing if heads[r] is None else ~missing & (plain == heads[r]))
                )
            ]
            to = [before[place[i]] for i in copies]
            chosen = pa.array(np.r_[np.arange(len(ids)), copies].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[place, to].astype(np.int64)),
                    pa.array(np.r_[np.zeros(len(ids), bool), np.ones(len(copies), bool)]),
                    ids.take(chosen),
                    texts.take(chosen),
                ],
                names=["_range", "_halo", "doc_id", "text"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        placed, "_range long, _halo boolean, doc_id long, text string"
    )


def fingerprints(docs: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they are.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The likenesses follow from the stored fingerprints alone (``fingerprint_likeness``).
    Documents are put in order of descending id, equal ids by their texts' hash
    and null ids last; the first follows the last. A null text is an empty one, and two
    texts without paragraphs have likeness 1. Repeated rows follow each other and get a row
    each; those of one id, or without an id, pass through one task, a group of about
    GROUP_BYTES at a time. A single document follows itself; an empty table gives no rows; other columns are
    ignored.
    """
    if n_ranges is None:
        n_ranges = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = (
        with_following(
            docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")), n_ranges
        )
        .withColumn("_tie", F.xxhash64("text"))
        .repartition(n_ranges, "_range")
        .sortWithinPartitions("_range", "_halo", F.desc_nulls_last("doc_id"), "_tie")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held, current, closed = 0, None, False

        def emit(last: str | None) -> pa.RecordBatch:
            """Rows of the texts held; ``last`` follows the last of them."""
            chain = texts if last is None else [*texts, last]
            columns = [ids[: len(chain) - 1], *compared(chain)]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[part.split()[0] for part in SCHEMA.split(", ")],
            )

        for batch in batches:
            cells = (batch.column(c).to_pylist() for c in ("_range", "_halo", "doc_id"))
            for place, halo, doc_id, value in zip(*cells, batch.column("text")):
                if place != current:
                    ids, texts, held, current, closed = [], [], 0, place, False
                if closed:
                    continue
                text = value.as_py()
                if halo:
                    if texts:
                        yield emit(text)
                    closed = True
                    continue
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= GROUP_BYTES and len(texts) > 1:
                    yield emit(None)
                    ids, texts = ids[-1:], texts[-1:]
                    held = len(texts[0])

    return in_order.select("_range", "_halo", "doc_id", "text").mapInArrow(rows, SCHEMA)
