"""Toxicity: a linear classifier over words, regularised by counterfactual sentences."""

from __future__ import annotations

import heapq
import re
import warnings
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.labelled import drawn_examples, kept_by_score, known_labels, remainder
from kindred.llm.textbytes import WordHasher, groups_of_documents, text_bytes, word_spans

DIMENSIONS = 1 << 20
# Word beginnings, in bytes, that are features beside whole words.
PREFIXES = (4, 5, 6, 7)
PER_CLASS = 2500
TRAIN_BYTES = 1 << 17
SWAPS_PER_DOC = 4
INSERTS_PER_DOC = 2
SWAP_SEED, INSERT_SEED = "swaps", "inserts"

# Groups of terms for people that are neutral in themselves. Terms of one group replace
# each other in counterfactual sentences.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)


def word_bytes() -> np.ndarray:
    """Which bytes do not belong to words: all ASCII but letters and digits."""
    outside = np.ones(256, bool)
    outside[0x30:0x3A] = outside[0x41:0x5B] = outside[0x61:0x7B] = outside[0x80:] = False
    return outside


class WordFeatures:
    """Numbers below ``DIMENSIONS`` for the words of a text and for the words' beginnings."""

    def __init__(self) -> None:
        self.hasher = WordHasher(seed=29)
        self.hasher.blank = word_bytes()

    def of_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(feature, document)``, repeats included."""
        starts, ends, owner = word_spans(data, offsets, self.hasher.blank)
        numbers, owners = [], []
        for width in (None, *PREFIXES):
            if width is None:
                first, last, whose = starts, ends, owner
            else:
                long = ends - starts > width
                first, whose = starts[long], owner[long]
                last = first + width
            hashed = self.hasher._hashes(data, first, last)
            numbers.append((hashed >> np.uint64(8)) % np.uint64(DIMENSIONS))
            owners.append(whose)
        return np.concatenate(numbers).astype(np.int64), np.concatenate(owners)

    def of_text(self, text: str) -> np.ndarray:
        """The distinct features of one text."""
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        found = [np.empty(0, np.int64)]
        for piece in self.hasher.pieces(raw):
            found.append(np.unique(self.of_bytes(piece, np.array([0, len(piece)]))[0]))
        return np.unique(np.concatenate(found))


def _sentences(text: str) -> list[str]:
    return re.split(r"(?<=[.!?])\s+|\n+", text)


def counterfactual_sentences(
    text: str, groups: Sequence[Sequence[str]] = IDENTITY_TERMS, most: int = SWAPS_PER_DOC
) -> Iterator[tuple[str, str]]:
    """Sentences that name a group, each with the same sentence naming another one.

    Of the places where the whole text names a group, ``most`` are drawn by a seeded hash.
    """
    of = {term: group for group in groups for term in group}

    def places() -> Iterator[tuple[int, int, int, str, str]]:
        for i, sentence in enumerate(_sentences(text)):
            seed = zlib.crc32(f"{SWAP_SEED} {i} {sentence}".encode())
            for k, word in enumerate(re.findall(r"\w+", sentence)):
                if len(of.get(word.lower(), ())) > 1:
                    yield zlib.crc32(str(k).encode(), seed), i, k, word, sentence

    drawn = sorted(heapq.nsmallest(most, places()), key=lambda place: place[1:3])
    for given, (_, _, _, word, sentence) in enumerate(drawn):
        term = word.lower()
        group = of[term]
        other = group[(group.index(term) + 1 + given) % len(group)]
        if other == term:
            other = group[(group.index(term) + 1) % len(group)]
        yield sentence, re.sub(rf"\b{re.escape(word)}\b", other, sentence)


def inserted_sentences(
    text: str, groups: Sequence[Sequence[str]] = IDENTITY_TERMS, most: int = INSERTS_PER_DOC
) -> Iterator[tuple[str, str]]:
    """Sentences of the text with a term set into them, each with another term of its group.

    Texts need not name any group for this. Of all words of the whole text, ``most`` are drawn by a seeded
    hash, which also draws the group and its two terms; the term stands before the word.
    """
    groups = [group for group in groups if len(group) > 1]
    if not groups:
        return

    def places() -> Iterator[tuple[int, int, int, str]]:
        for i, sentence in enumerate(_sentences(text)):
            seed = zlib.crc32(f"{INSERT_SEED} {i} {sentence}".encode())
            for word in re.finditer(r"\w+", sentence):
                yield zlib.crc32(str(word.start()).encode(), seed), i, word.start(), sentence

    for turn, _, start, sentence in sorted(heapq.nsmallest(most, places()), key=lambda place: place[1:3]):
        group = groups[turn % len(groups)]
        one = turn // len(groups) % len(group)
        other = (one + 1 + turn // len(groups) // len(group) % (len(group) - 1)) % len(group)
        yield tuple(f"{sentence[:start]}{group[k]} {sentence[start:]}" for k in (one, other))


@dataclass
class LinearModel:
    """Weights of the features kept, sorted by feature."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        table = np.zeros(DIMENSIONS, np.float32)
        table[self.features] = self.weights
        return table


def _telling(rows: np.ndarray, cols: np.ndarray, label: np.ndarray, least: float) -> np.ndarray:
    """Features whose share among toxic and other documents differs by ``least`` standard errors."""
    size = int(cols.max(initial=-1)) + 1
    pos = np.bincount(cols, weights=label[rows], minlength=size)
    every = np.bincount(cols, minlength=size)
    n1, n0 = max(label.sum(), 1), max((1 - label).sum(), 1)
    mean = every / (n1 + n0)
    error = np.sqrt(mean * (1 - mean) * (1 / n1 + 1 / n0)) + 1e-9
    z = np.abs(pos / n1 - (every - pos) / n0) / error
    return np.flatnonzero((z >= least) & (every >= 3))


def fit_linear(
    examples: Sequence[tuple[float, np.ndarray]],
    swaps: Sequence[tuple[np.ndarray, np.ndarray]],
    penalty: float = 5.0,
    l2: float = 1e-4,
    steps: int = 200,
    rate: float = 0.1,
    least_z: float = 3.5,
) -> LinearModel:
    """Logistic loss, plus ``penalty`` times the mean squared score change over ``swaps``.

    A swap is the features of a sentence and of its counterfactual. The score of a
    linear model changes only through features that one of the two lacks.
    """
    label = np.array([y for y, _ in examples], float)
    if not len(label) or label.min() == label.max():
        share = float(label.mean()) if len(label) else 0.0
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return LinearModel(np.empty(0, np.int64), np.empty(0), bias)
    rows = np.repeat(np.arange(len(examples)), [len(f) for _, f in examples])
    cols = np.concatenate([f for _, f in examples])
    kept = _telling(rows, cols, label, least_z)
    inside = np.isin(cols, kept)
    rows, cols = rows[inside], np.searchsorted(kept, cols[inside])
    changes = [
        (np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in swaps if not np.array_equal(a, b)
    ]
    swap_rows = np.concatenate(
        [np.repeat(i, len(a) + len(b)) for i, (a, b) in enumerate(changes)] or [np.empty(0, int)]
    ).astype(int)
    swap_cols = np.concatenate([np.concatenate(c) for c in changes] or [np.empty(0, np.int64)])
    signs = np.concatenate(
        [np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in changes] or [np.empty(0)]
    )
    inside = np.isin(swap_cols, kept)
    swap_rows, swap_cols, signs = (
        swap_rows[inside],
        np.searchsorted(kept, swap_cols[inside]),
        signs[inside],
    )
    # Both classes weigh the same.
    weight = np.where(label > 0, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    w, bias = np.zeros(len(kept)), 0.0
    mean, square = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=w[cols], minlength=len(label)) + bias
        off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * weight
        gradient = np.bincount(cols, weights=off[rows], minlength=len(kept)) + l2 * w
        if len(changes):
            moved = np.bincount(swap_rows, weights=signs * w[swap_cols], minlength=len(changes))
            gradient += (2 * penalty / len(changes)) * np.bincount(
                swap_cols, weights=signs * moved[swap_rows], minlength=len(kept)
            )
        gradient = np.append(gradient, off.sum())
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return LinearModel(kept, w, float(bias))


def training_rows(examples: DataFrame, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> DataFrame:
    """``(label, kind, features, others)`` of labelled texts, worked out where the texts are."""
    terms = [list(group) for group in terms]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = WordFeatures()
        for batch in batches:
            out: list[tuple] = []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                out.append((float(label), "text", features.of_text(text).astype("<i4").tobytes(), None))
                for one, other in (*counterfactual_sentences(text, terms), *inserted_sentences(text, terms)):
                    pair = (features.of_text(s).astype("<i4").tobytes() for s in (one, other))
                    out.append((float(label), "swap", *pair))
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = [pa.float64(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["label", "kind", "features", "others"],
            )

    return examples.select("label", "text").mapInArrow(
        rows, "label double, kind string, features binary, others binary"
    )


def train(
    docs: DataFrame,
    known: DataFrame,
    per_class: int = PER_CLASS,
    penalty: float = 5.0,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> LinearModel:
    """Fit on at most about ``per_class`` texts of each label, and their counterfactual sentences.

    ``known`` are ``(doc_id, label)``, ``terms`` groups of terms that may replace each other: those that a text
    names, and some set into sentences that name none. Texts over ``TRAIN_BYTES`` are not learned
    from, which bounds what the driver holds.
    """
    examples = drawn_examples(docs, known, per_class, "toxicity")
    found = training_rows(examples.where(F.octet_length("text") <= TRAIN_BYTES), terms).collect()
    found.sort(key=lambda r: (r.kind, r.label, bytes(r.features), bytes(r.others or b"")))
    numbers = lambda raw: np.frombuffer(raw, "<i4").astype(np.int64)
    swaps = [(numbers(r.features), numbers(r.others)) for r in found if r.kind == "swap"]
    if found and terms and not swaps:
        warnings.warn("no labelled text has a word, so there are no counterfactual sentences", stacklevel=2)
    return fit_linear(
        [(r.label, numbers(r.features)) for r in found if r.kind == "text"], swaps, penalty
    )


def score(docs: DataFrame, model: LinearModel) -> DataFrame:
    """``docs`` with ``score``: the probability that a whole text is toxic.

    Every distinct feature of a text counts once, however long the text is.
    """
    others = [c for c in docs.columns if c not in ("text", "score")]
    kept, weights, bias = model.features, model.weights, model.bias

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = WordFeatures()
        table = np.zeros(DIMENSIONS, np.float32)
        table[kept] = weights
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            z = np.full(len(batch), bias)
            for low, high in groups_of_documents(offsets):
                part = data[offsets[low] : offsets[high]]
                if high == low + 1:
                    pieces = list(features.hasher.pieces(part))
                    cuts = [np.array([0, len(p)]) for p in pieces]
                else:
                    pieces, cuts = [part], [offsets[low : high + 1] - offsets[low]]
                met = []
                for piece, cut in zip(pieces, cuts):
                    numbers, owner = features.of_bytes(piece, cut)
                    telling = table[numbers] != 0
                    met.append((owner[telling] << 20) | numbers[telling])
                distinct = np.unique(np.concatenate(met)) if met else np.empty(0, np.int64)
                z[low:high] += np.bincount(
                    distinct >> 20, weights=table[distinct & (DIMENSIONS - 1)], minlength=high - low
                )
            probability = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(probability)], names=[*others, "score"]
            )

    shape = StructType([docs.schema[c] for c in others])
    return docs.select(*others, "text").mapInArrow(scored, shape.add("score", "double"))


def toxicity(
    docs: DataFrame, labels: DataFrame, terms: Sequence[Sequence[str]] = IDENTITY_TERMS
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document.

    Learned from rows of ``labels`` whose id is not held out; labels, language, source
    and id are no inputs. Scores are held level between sentences that differ in a term of one group of ``terms``. A null text scores as an empty one, which has no feature and so
    the model's base score; a null id is not held out. Repeated rows are scored each, an
    empty table gives no rows, and without labels all score alike and low. Other
    columns are ignored.
    """
    model = train(docs, known_labels(labels, "toxic"), terms=terms)
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    reject: float = 0.5,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
) -> DataFrame:
    """The documents that score below ``reject``, with all their columns."""
    model = train(docs, known_labels(labels, "toxic"), terms=terms)
    return kept_by_score(docs, lambda rows: score(rows, model), F.col("score") < reject)
