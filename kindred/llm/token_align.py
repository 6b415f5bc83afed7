"""Alignment of two tokenizers over all documents: groups, links and corpus-wide link counts."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.skew import join_counted
from kindred.storage import staged

MARK = "▁"
# Bytes of text whose link pairs are looked up together, and bytes encoded at a time.
BLOCK_BYTES, GROUP_BYTES = 1 << 23, 1 << 18
# Tokens of windows kept for reuse, after which a task begins anew.
KEPT_TOKENS = 2_000_000
# Links of a group up to which they are listed one by one.
SMALL_GROUP = 64
# Stands between the ids of a window; no id.
STROKE = -1


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes, in order, for the
    characters from 256 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


# How words are cut out of a text before they are encoded, a fixed pattern of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_BLANK = re.compile(r"\s{4096}")


class ByteLevel:
    """A ``tokenizers`` file of byte-level entries; strings of special tokens are plain text.

    Where its merges amount to ranks, see ``_ranked``, texts are encoded by ``tiktoken``, which gives
    the same ids several times as fast; but not texts with very long white space, which it cannot take.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        values = byte_alphabet()
        self.spelled = [b""] * self.model.get_vocab_size()
        for entry, token in self.model.get_vocab().items():
            known = all(c in values for c in entry)
            self.spelled[token] = bytes(values[c] for c in entry) if known else entry.encode()
        self.ranked = self._ranked()

    def _ranked(self):
        """A ``tiktoken`` encoder of the same ids, or None.

        Both merge neighbours until none can be. One takes the first pair of a list of merges, the other the
        pair that spells the entry of the least id. They agree if merges are listed by the ids of what they make
        and the bytes of each entry, merged by lesser ids only, end as the very pair that its merge lists: what
        happens inside an entry's bytes before it is made does not depend on what stands around them.
        """
        import json

        import tiktoken

        spec = json.loads(self.model.to_str())
        model, words = spec["model"], spec["pre_tokenizer"]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if spec["normalizer"] or model["type"] != "BPE" or any(model.get(o) for o in options):
            return None
        if not words or any(words.get(k) != v for k, v in plain.items()):
            return None
        added = {a["content"] for a in spec["added_tokens"]}
        ranks = {self.spelled[i]: i for entry, i in model["vocab"].items() if entry not in added}
        made = -1
        for merge in model["merges"]:
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            pair = [self.spelled[model["vocab"][e]] for e in (first, second)]
            rank = ranks.get(b"".join(pair), -1)
            if rank <= made or _merged(b"".join(pair), ranks, rank) != pair:
                return None
            made = rank
        if len(ranks) != len(model["merges"]) + 256:
            return None
        return tiktoken.Encoding("ranked", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        whole = [" " + text for text in texts]
        if self.ranked is None or any(LONG_BLANK.search(t) for t in whole if len(t) > 4096):
            found = [e.ids for e in self.model.encode_batch(whole, add_special_tokens=False)]
        else:
            found = map(self.ranked.encode_ordinary, whole)
        return [np.array(ids, np.int32) for ids in found]


def _merged(raw: bytes, ranks: dict[bytes, int], limit: int) -> list[bytes]:
    """Bytes merged pair by pair, least rank first, as long as a rank is below the limit."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while len(parts) > 1:
        pairs = [ranks.get(x + y, limit) for x, y in zip(parts, parts[1:])]
        least = min(pairs)
        if least >= limit:
            break
        at = pairs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Pieces:
    """A sentencepiece model, which sets a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelled = [
            bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.array(ids, np.int32) for ids in self.model.encode(list(texts), num_threads=1)]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of spans that begin at ``starts`` and have these sizes, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Aligner:
    """Aligns token ids of texts, window by window.

    A window is kept with its number under its ids, those of a, a stroke and those of b as bytes, so that an
    equal one is not aligned again. Its groups, links and pairs are kept by number, pairs one window's after
    the other's.
    """

    def __init__(self, a: ByteLevel, b: Pieces, kept_tokens: int = KEPT_TOKENS):
        self.spelled = [np.frombuffer(b"".join(side.spelled), np.uint8) for side in (a, b)]
        self.sizes = [np.array([len(s) for s in side.spelled], np.int64) for side in (a, b)]
        self.starts = [np.cumsum(sizes) - sizes for sizes in self.sizes]
        self.marked = [np.array([s[:1] == b" " for s in side.spelled]) for side in (a, b)]
        # Each id as text with a comma, and with what ends its part of a group.
        self.names = [
            np.array([f"{i}{end}" for end in ends for i in range(len(side.spelled))], object)
            for side, ends in ((a, ",|"), (b, ",;"))
        ]
        self.width = len(b.spelled)
        self.kept_tokens = kept_tokens
        self._forget()

    def _forget(self) -> None:
        self.n_kept = 0
        self.known: dict[bytes, int] = {}
        # What both sides of a window spell; of one whose sides differ a byte that is in no text.
        self.bytes: list[bytes] = []
        self.texts: list[str] = []
        self.n_groups, self.n_links = array("q"), array("q")
        self.pairs, self.times, self.ends = array("q"), array("q"), array("q", [0])

    def aligned(
        self, raws: Sequence[bytes], of_a: Sequence[np.ndarray], of_b: Sequence[np.ndarray]
    ) -> list[tuple | None]:
        """Of each text ``(n_a, n_b, groups text, n_groups, n_links, pairs, times)``.

        None if its tokens do not spell it. ``pairs`` are the numbers of the id pairs linked, each once,
        ``times`` how many links each has.
        """
        if self.n_kept > self.kept_tokens:
            self._forget()
        lengths = np.array([len(raw) for raw in raws])
        fit = lengths > 0
        for size, ids in zip(self.sizes, (of_a, of_b)):
            fit &= np.array([size[i].sum() for i in ids]) == lengths
        places = np.flatnonzero(fit).tolist()
        found: list[tuple | None] = [None] * len(raws)
        if places:
            ids = [np.concatenate([side[k] for k in places]) for side in (of_a, of_b)]
            windows, ends = self._windows(ids, lengths[fit])
            for k, low, high, parts in zip(places, [0, *ends], ends, self._together(windows, ends)):
                if b"".join(map(self.bytes.__getitem__, windows[low:high])) == raws[k]:
                    found[k] = len(of_a[k]), len(of_b[k]), *parts
        return found

    def _windows(self, ids: Sequence[np.ndarray], lengths: np.ndarray) -> tuple[list[int], list[int]]:
        """Numbers of the windows of texts one after the other, and where those of each end.

        Windows lie between anchors: ends of both before tokens that begin with a space.
        """
        starts = [np.cumsum(size[i]) - size[i] for size, i in zip(self.sizes, ids)]
        begins = [start[mark[i]] for start, mark, i in zip(starts, self.marked, ids)]
        texts = np.cumsum(lengths)
        anchors = np.union1d(np.intersect1d(*begins, assume_unique=True), texts)
        anchors = anchors[anchors > 0]
        cuts = [np.append(np.searchsorted(start, anchors[:-1]), len(i)) for start, i in zip(starts, ids)]
        sizes = [np.diff(c, prepend=0) for c in cuts]
        # All windows one after the other, the ids of a, a stroke and those of b in each.
        highs = np.cumsum(sizes[0] + sizes[1] + 1)
        lows = highs - sizes[0] - sizes[1] - 1
        laid = np.full(highs[-1], STROKE, np.int32)
        laid[_spans(lows, sizes[0])] = ids[0]
        laid[_spans(lows + sizes[0] + 1, sizes[1])] = ids[1]
        packed = laid.tobytes()
        keys = [packed[low:high] for low, high in zip((4 * lows).tolist(), (4 * highs).tolist())]
        found = list(map(self.known.get, keys))
        n_left = sizes[0].tolist()
        new: dict[bytes, int] = {}
        for k in [k for k, number in enumerate(found) if number is None]:
            found[k] = self.known.setdefault(keys[k], len(self.known))
            new[keys[k]] = 4 * n_left[k]
        self._learn(new)
        return found, (np.searchsorted(anchors, texts) + 1).tolist()

    def _learn(self, new: dict[bytes, int]) -> None:
        """Align windows, given with the bytes of their a ids: a group ends wherever tokens of both do."""
        if not new:
            return
        ids = [
            np.frombuffer(b"".join(side), np.int32).astype(np.int64)
            for side in ([w[:n] for w, n in new.items()], [w[n + 4 :] for w, n in new.items()])
        ]
        self.n_kept += len(ids[0]) + len(ids[1])
        n_tokens = [
            np.fromiter(sizes, np.int64, len(new)) // 4
            for sizes in (new.values(), (len(w) - n - 4 for w, n in new.items()))
        ]
        ends = [np.cumsum(size[i]) for size, i in zip(self.sizes, ids)]
        self._keep_bytes(ids, ends[0][np.cumsum(n_tokens[0]) - 1])
        groups = np.intersect1d(*ends, assume_unique=True)
        # Of each token its group, of each group the number of tokens so far, of each window of groups.
        owner = [np.searchsorted(groups, e) for e in ends]
        upto = [np.searchsorted(e, groups) + 1 for e in ends]
        n_of = [np.diff(u, prepend=0) for u in upto]
        last_group = np.searchsorted(groups, ends[0][np.cumsum(n_tokens[0]) - 1]) + 1
        links = n_of[0] * n_of[1]
        links_upto = np.append(0, np.cumsum(links))[np.append(0, last_group)]
        self.n_groups.frombytes(np.diff(last_group, prepend=0).tobytes())
        self.n_links.frombytes(np.diff(links_upto).tobytes())
        self._keep_texts(ids, owner, upto, last_group)
        self._keep_pairs(ids, owner, upto, n_of, links, last_group)

    def _keep_bytes(self, ids: list[np.ndarray], ends: np.ndarray) -> None:
        """What windows with these ends spell."""
        a, b = [
            spelled[_spans(start[i], size[i])]
            for spelled, start, size, i in zip(self.spelled, self.starts, self.sizes, ids)
        ]
        wrong = set(np.searchsorted(ends, np.flatnonzero(a != b), "right").tolist())
        raw, low = a.tobytes(), 0
        for k, high in enumerate(ends.tolist()):
            self.bytes.append(b"\xff" if k in wrong else raw[low:high])
            low = high

    def _keep_texts(self, ids, owner, upto, last_group) -> None:
        """Text of each window: tokens in the order of groups, a before b."""
        parts = np.empty(len(ids[0]) + len(ids[1]), object)
        before = (np.append(0, upto[1])[owner[0]], upto[0][owner[1]])
        for side in (0, 1):
            last = np.zeros(len(ids[side]), np.int64)
            last[upto[side] - 1] = len(self.sizes[side])
            parts[np.arange(len(last)) + before[side]] = self.names[side][ids[side] + last]
        low = 0
        listed = parts.tolist()
        for high in (upto[0] + upto[1])[last_group - 1].tolist():
            self.texts.append("".join(listed[low:high]))
            low = high

    def _keep_pairs(self, ids, owner, upto, n_of, links, last_group) -> None:
        """Pairs of each window with how often they are linked; a pair may come again within a window."""
        short = links <= SMALL_GROUP
        repeats = np.where(short, n_of[1], 0)[owner[0]]
        left = np.repeat(ids[0], repeats)
        first = np.repeat((upto[1] - n_of[1])[owner[0]], repeats)
        turn = np.arange(len(left)) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        pairs = left * self.width + ids[1][first + turn]
        times = np.ones(len(pairs), np.int64)
        n_pairs = np.where(short, links, 0)
        more = []
        for group in np.flatnonzero(~short):
            # Ids that a long group repeats are multiplied, not taken by occurrence.
            (some, n_some), (others, n_others) = [
                np.unique(i[u[group] - n[group] : u[group]], return_counts=True)
                for i, u, n in zip(ids, upto, n_of)
            ]
            more.append((group, (some[:, None] * self.width + others).ravel(), np.outer(n_some, n_others).ravel()))
            n_pairs[group] = len(some) * len(others)
        if more:
            place = np.cumsum(np.where(short, links, 0))
            at = np.concatenate([np.full(len(p), place[g]) for g, p, _ in more])
            pairs = np.insert(pairs, at, np.concatenate([p for _, p, _ in more]))
            times = np.insert(times, at, np.concatenate([t for _, _, t in more]))
        base = len(self.pairs)
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())
        self.ends.frombytes((base + np.cumsum(n_pairs)[last_group - 1]).tobytes())

    def _together(self, windows: list[int], text_ends: list[int]) -> Iterator[tuple]:
        """What the windows of each text have together."""
        used, upto = np.array(windows), np.array(text_ends)
        n_windows = np.diff(upto, prepend=0)
        owner = np.repeat(np.arange(len(upto)), n_windows)
        totals = [
            np.bincount(owner, np.frombuffer(n, np.int64)[used], len(upto)).astype(np.int64).tolist()
            for n in (self.n_groups, self.n_links)
        ]
        ends = np.frombuffer(self.ends, np.int64)
        sizes = ends[used + 1] - ends[used]
        places = _spans(ends[used], sizes)
        # Pairs in the order of texts, then numbers; equal ones are neighbours.
        n_numbers = len(self.sizes[0]) * self.width
        keys = np.frombuffer(self.pairs, np.int64)[places] + np.repeat(owner * n_numbers, sizes)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(np.frombuffer(self.times, np.int64)[places][order], first)
        pairs = keys[first] % n_numbers
        cuts = np.searchsorted(keys[first], np.arange(1, len(upto) + 1) * n_numbers).tolist()
        spans = zip([0, *text_ends], text_ends, [0, *cuts], cuts)
        for k, (low, high, from_pair, to_pair) in enumerate(spans):
            text = "".join(map(self.texts.__getitem__, windows[low:high]))[:-1]
            yield text, totals[0][k], totals[1][k], pairs[from_pair:to_pair], times[from_pair:to_pair]


class _Block:
    """Rows of documents that share one list of distinct pairs."""

    FIELDS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self):
        self.size = 0
        self.rows: list[tuple] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, n_bytes: int, found: tuple | None) -> None:
        self.size += n_bytes
        if found is None:
            self.rows.append((0, 0, 0, 0))
            self.digests.append("")
            self.pairs.append(np.empty(0, np.int64))
            self.times.append(np.empty(0, np.int64))
            return
        n_a, n_b, text, n_groups, n_links, pairs, times = found
        self.rows.append((n_a, n_b, n_groups, n_links))
        self.digests.append(hashlib.sha256(text.encode()).hexdigest())
        self.pairs.append(pairs)
        self.times.append(times)

    def batch(self, ids: pa.Array, number: str) -> pa.RecordBatch:
        pairs, local, n_docs = np.unique(
            np.concatenate(self.pairs), return_inverse=True, return_counts=True
        )
        counts = np.array(self.rows, np.int64).reshape(-1, 4)
        columns = [
            pa.array([number]),
            _one_list(ids),
            *[_one_list(pa.array(counts[:, i])) for i in range(4)],
            _one_list(pa.array(self.digests, pa.string())),
            _one_list(pa.array(np.array([len(p) for p in self.pairs], np.int32))),
            pa.array([_narrow(local)], pa.binary()),
            pa.array([_narrow(np.concatenate(self.times))], pa.binary()),
            _one_list(pa.array(pairs)),
            _one_list(pa.array(n_docs.astype(np.int64))),
        ]
        names = ["block", "doc_id", *self.FIELDS, "groups_sha256", "n_pairs", "local", "times", "pairs", "n_docs"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(raw: pa.Scalar, n: int) -> np.ndarray:
    """The n numbers of ``_narrow``."""
    held = raw.as_buffer()
    return np.frombuffer(held, f"u{held.size // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _block_schema(id_type: str) -> str:
    numbers = ", ".join(f"{n} array<long>" for n in _Block.FIELDS)
    return (
        f"block string, doc_id array<{id_type}>, {numbers}, groups_sha256 array<string>, "
        "n_pairs array<int>, local binary, times binary, pairs array<long>, n_docs array<long>"
    )


def aligned_blocks(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    kept_tokens: int = KEPT_TOKENS,
) -> DataFrame:
    """One row for every block of documents, in lists of equal length.

    A block holds neighbours of up to ``block_bytes`` of text together, or one longer document. ``pairs`` are
    its distinct link pairs, ``n_docs`` the number of its documents that hold each; of each document
    ``n_pairs`` entries of ``local``, places in ``pairs``, and of ``times``, how often it is linked. These two are by
    far the longest and are packed, as a row is held several times on its way through a task.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        a = ByteLevel(a_path or public_tokenizers.path("byte_bpe_50k.json"))
        b = Pieces(b_path or public_tokenizers.path("piece_bpe_32k.model"))
        aligner = Aligner(a, b, kept_tokens)
        numbers = (f"{TaskContext.get().partitionId()}-{n}" for n in count())
        for batch in batches:
            column = batch.column("text")
            sizes = pc.binary_length(column).fill_null(0).to_pylist()
            low, block = 0, _Block()
            for first, last in _groups(sizes, GROUP_BYTES):
                texts = [t or "" for t in column.slice(first, last - first).to_pylist()]
                raws = [b" " + t.encode() if t else b"" for t in texts]
                for raw, found in zip(raws, aligner.aligned(raws, a.encode(texts), b.encode(texts))):
                    block.add(len(raw), found)
                more = sizes[last] if last < len(sizes) else 0
                if last == len(sizes) or block.size + more >= block_bytes:
                    yield block.batch(batch.column("doc_id").slice(low, last - low), next(numbers))
                    low, block = last, _Block()

    return docs.select("doc_id", "text").mapInArrow(blocks, _block_schema(id_type))


def _groups(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most ``limit`` bytes together, or of one that has more."""
    low = held = 0
    for k, size in enumerate(sizes):
        if k > low and held + size > limit:
            yield low, k
            low, held = k, 0
        held += size
    if low < len(sizes):
        yield low, len(sizes)


def link_counts(blocks: DataFrame, width: int) -> DataFrame:
    """``(pair, n_blocks, count, is_best)`` of every id pair that is linked anywhere.

    ``count`` is the number of documents that hold it; best is a pair of its a id's highest count.
    """
    rows = blocks.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p"))
    counts = staged(
        rows.groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.count("*").alias("n_blocks"), F.sum("p.n_docs").alias("count"))
        .withColumn("a", F.expr(f"pair div {width}")),
        "link-counts",
    )
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select(
        "pair", "n_blocks", "count", (F.col("count") == F.col("highest")).alias("is_best")
    )


def _sums(block: pa.Table) -> pa.Table:
    """Rows of documents from the one row of their block with the counts of its pairs."""
    packed = ("local", "times")
    names = [n for n in block.column_names if n not in ("block", *packed)]
    row = {n: block.column(n).combine_chunks().flatten() for n in names}
    sizes = row["n_pairs"].to_numpy().astype(np.int64)
    local, times = (_wide(block.column(n)[0], int(sizes.sum())) for n in packed)
    # Running totals give the sum over each document's entries.
    ends = np.cumsum(sizes)
    sums = {}
    for name, values in (("n_best", "best"), ("count_sum", "counts")):
        running = np.append(0, np.cumsum(row[values].to_numpy().astype(np.int64)[local] * times))
        sums[name] = pa.array(running[ends] - running[ends - sizes])
    kept = {n: row[n] for n in ("doc_id", *_Block.FIELDS)}
    return pa.table({**kept, **sums, "groups_sha256": row["groups_sha256"]})


def alignment(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    block_bytes: int = BLOCK_BYTES,
    kept_tokens: int = KEPT_TOKENS,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every document.

    ``a_path`` is a byte-level ``tokenizers`` file, ``b_path`` a sentencepiece model that sets a space
    before a text, both on the workers and by default the installed ones. After both have encoded a whole text, places
    where tokens of both end and the next ones begin with a space cut it into windows of token ids;
    equal windows are aligned once a task. Wherever tokens of both end at one byte, a group ends; all pairs of
    an a and a b token of one group are links. An id pair counts once for every document, that is row, which
    holds it linked. ``n_best`` are the links whose count is the highest of their a id, ties included,
    ``count_sum`` the sum of counts over links.

    Pairs are counted and looked up block by block, each distinct pair of a block once: pairs of all
    documents are never listed, the table of counts is never sent to all tasks, and pairs that nearly all
    blocks hold are not shuffled. A block is as large as ``block_bytes`` of text or its one longer document.

    A text that is null or empty, or whose tokens do not spell a space and the text, has zeros and an empty
    digest. Null ids pass through, repeated rows count each, an empty table gives no rows, other
    columns are ignored.
    """
    if b_path is None:
        import public_tokenizers

        width = len(Pieces(public_tokenizers.path("piece_bpe_32k.model")).spelled)
    else:
        width = len(Pieces(b_path).spelled)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blocks = staged(aligned_blocks(docs, a_path, b_path, block_bytes, kept_tokens), "aligned-blocks")
    counts = staged(link_counts(blocks, width), "best-links")
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    found = (
        join_counted(asked, counts, ["pair"], "n_blocks")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "count", "is_best"))).alias("found"))
        .select(
            "block",
            F.col("found.count").alias("counts"),
            F.transform("found.is_best", lambda best: best.cast("int")).alias("best"),
        )
    )
    empty = F.array()
    joined = blocks.drop("pairs", "n_docs").join(found, "block", "left").withColumns(
        {
            "counts": F.coalesce("counts", empty.cast("array<long>")),
            "best": F.coalesce("best", empty.cast("array<int>")),
        }
    )
    numbers = ", ".join(f"{n} long" for n in (*_Block.FIELDS, "n_best", "count_sum"))
    # A task holds one block at a time.
    return joined.groupBy("block").applyInArrow(_sums, f"doc_id {id_type}, {numbers}, groups_sha256 string")
