"""Language identification: sparse multinomial regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.labelled import remainder, sample_of_classes

DIMENSIONS = 1 << 13
PER_LANGUAGE = 500
MAX_LANGUAGES = 256
TRAIN_BYTES = 1 << 16
# Characters of a long text that are counted at a time.
PART = 1 << 18
UNKNOWN = "und"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """How often each hashed run of one to three characters of the lower-case text occurs."""
    total = np.zeros(DIMENSIONS, np.int64)
    lowered = text.lower()
    for low in range(0, max(len(lowered), 1), PART):
        # Parts share two characters, and runs that begin in the shared ones belong to the later part.
        part = lowered[low : low + PART + 2]
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(PART, len(c))
        one = c * np.uint32(2654435761)
        total += np.bincount(one[:own] >> np.uint32(19), minlength=DIMENSIONS)
        if len(c) > 1:
            two = (one[:-1] * np.uint32(2246822519)) ^ (c[1:] * np.uint32(3266489917))
            two = two * np.uint32(668265263)
            total += np.bincount(two[:own] >> np.uint32(19), minlength=DIMENSIONS)
        if len(c) > 2:
            three = (two[:-1] * np.uint32(374761393)) ^ (c[2:] * np.uint32(2654435789))
            three = three * np.uint32(2246822519)
            total += np.bincount(three[:own] >> np.uint32(19), minlength=DIMENSIONS)
    return total


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and unit-length values of a text's counts."""
    there = np.flatnonzero(counts)
    values = (1 + np.log(counts[there])) * idf[there]
    length = np.sqrt(values @ values)
    return there, values / length if length else values


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        there, values = tf_idf(counts, self.idf)
        return softmax(values @ self.weights[there] / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class FollowTheRegularisedLeader:
    """FTRL-proximal with elastic net: one row of weights per feature, one column per class."""

    def __init__(self, n_classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((DIMENSIONS, n_classes))
        self.n = np.zeros((DIMENSIONS, n_classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, there: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[there], self.n[there]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, there: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(there)
        off = softmax(values @ w)
        off[label] -= 1
        gradient = values[:, None] * off
        n = self.n[there]
        step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha
        self.z[there] += gradient - step * w
        self.n[there] = n + gradient**2


def fit_model(
    examples: Sequence[tuple[str, np.ndarray]],
    idf: np.ndarray,
    epochs: int = 4,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.01,
    seed: int = 3,
) -> LanguageModel:
    """Learn from four fifths of the examples, set the temperature by the rest."""
    languages = sorted({lang for lang, _ in examples})
    place = {lang: k for k, lang in enumerate(languages)}
    vectors = [(place[lang], *tf_idf(counts, idf)) for lang, counts in examples]
    random = np.random.default_rng(seed)
    order = random.permutation(len(vectors))
    n_tuning = len(vectors) // 5
    tuning, learning = order[:n_tuning], order[n_tuning:]
    leader = FollowTheRegularisedLeader(max(len(languages), 1), alpha, beta, l1, l2)
    for _ in range(epochs):
        for i in random.permutation(learning):
            label, there, values = vectors[i]
            leader.learn(there, values, label)
    weights = leader.weights()
    temperature = 1.0
    if n_tuning:
        logits = np.array([vectors[i][2] @ weights[vectors[i][1]] for i in tuning])
        truth = np.array([vectors[i][0] for i in tuning])
        at = np.geomspace(0.02, 5, 60)
        loss = [-np.log(softmax(logits / t)[np.arange(n_tuning), truth] + 1e-12).mean() for t in at]
        temperature = float(at[int(np.argmin(loss))])
    return LanguageModel(languages, idf, weights, temperature)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and how many have each feature, over all of ``docs``.

    Each task counts its own documents in one fixed array; the sums are Spark's, and
    one number per feature comes to the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen += ngram_counts(text.as_py()) > 0
                n += 1
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[there, -1]), pa.array(np.r_[seen[there], n])], names=["feature", "n"]
        )

    sums = docs.select("text").mapInArrow(counted, "feature long, n long").groupBy("feature")
    found = {row.feature: row.n for row in sums.agg(F.sum("n").alias("n")).collect()}
    total = found.pop(-1, 0) or 0
    seen = np.zeros(DIMENSIONS, np.int64)
    seen[list(found)] = list(found.values())
    return total, seen


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES
) -> LanguageModel:
    """Fit on ``(doc_id, text, lang)``: frequencies from all rows, weights from a bounded sample.

    The sample has about ``per_language`` texts of each of the ``max_languages`` most
    frequent languages, none over ``TRAIN_BYTES``.
    """
    known = docs.where("text is not null and lang is not null")
    total, seen = document_frequencies(known)
    idf = np.log((1 + total) / (1 + seen)) + 1
    usable = known.where(F.octet_length("text").between(1, TRAIN_BYTES))
    drawn = sample_of_classes(usable, "lang", per_language, max_languages, "language")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                counts = ngram_counts(text.as_py())
                there = np.flatnonzero(counts)
                rows.append((there.astype("<i4").tobytes(), counts[there].astype("<i4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([a for a, _ in rows], pa.binary()),
                    pa.array([b for _, b in rows], pa.binary()),
                ],
                names=["lang", "there", "counts"],
            )

    rows = drawn.select("lang", "text").mapInArrow(counted, "lang string, there binary, counts binary")
    examples = []
    for row in sorted(rows.collect(), key=lambda r: (r.lang, bytes(r.there), bytes(r.counts))):
        counts = np.zeros(DIMENSIONS, np.int64)
        counts[np.frombuffer(row.there, "<i4")] = np.frombuffer(row.counts, "<i4")
        examples.append((row.lang, counts))
    return fit_model(examples, idf)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and its calibrated probability ``score``."""
    others = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for value in batch.column("text"):
                text = value.as_py()
                if text is None or not model.languages or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = model.probabilities(ngram_counts(text))
                best = int(p.argmax())
                names.append(model.languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others]
                + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*others, "lang_pred", "score"],
            )

    shape = StructType([docs.schema[c] for c in others])
    shape = shape.add("lang_pred", "string").add("score", "double")
    return docs.select(*others, "text").mapInArrow(predicted, shape)


def languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every document.

    Learned from texts with a language whose id is not held out; language, source and id are no
    inputs of a prediction. Null texts, texts without a letter, and all texts where there is
    nothing to learn from, are ``und`` with score 0. A null id is neither held out nor
    learned from; repeated rows are predicted each; an empty table gives no rows.
    Other columns are ignored.
    """
    part = remainder(F.col("doc_id"), 3)
    model = train(docs.where(part != 1).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
