"""Quality: a convolutional network over the bytes of a whole document, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.llm.labelled import drawn_examples, kept_by_score, known_labels, remainder
from kindred.llm.textbytes import groups_of_documents, text_bytes

# A filter sees two blocks of four bytes and moves one block at a time.
BLOCK = 4
CHANNELS = 8
FILTERS = 16
# Filter places per chunk, and how far the next chunk begins: chunks share 16 places.
CHUNK = 128
STRIDE = 112
PER_CLASS = 1200
TRAIN_BYTES = 1 << 16
STEP_BYTES = 1 << 18
# Chunks of one long document that are held at a time.
PART_BYTES = BLOCK * STRIDE * 512


@dataclass
class ByteNetwork:
    """Byte embedding, filters over two blocks, and weights of the mean and the largest chunk."""

    embedding: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    head: np.ndarray
    bias: float

    @classmethod
    def fresh(cls, seed: int = 5) -> ByteNetwork:
        random = np.random.default_rng(seed)
        draw = lambda *s, scale: (random.standard_normal(s) * scale).astype(np.float32)
        return cls(
            draw(256, CHANNELS, scale=0.5),
            draw(2 * BLOCK * CHANNELS, FILTERS, scale=0.15),
            np.zeros(FILTERS, np.float32),
            draw(2 * FILTERS, scale=0.1),
            0.0,
        )


def blocks_of(data: np.ndarray, offsets: np.ndarray, ends: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Documents filled up with zero bytes to whole blocks, at least two, and their block counts.

    A block of zero bytes follows each, unless none of them ``ends`` here.
    """
    sizes = np.diff(offsets)
    counts = np.maximum(-(-sizes // BLOCK) + int(ends), 2)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]) * BLOCK
    filled = np.zeros(int(counts.sum()) * BLOCK, np.uint8)
    filled[np.arange(len(data)) + np.repeat(begins - offsets[:-1], sizes)] = data
    return filled, counts


def chunks_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, owner)``: the filter places of each chunk, the last one repeated to fill up."""
    places = counts - 1
    n_chunks = np.maximum(-(-(places - (CHUNK - STRIDE)) // STRIDE), 1)
    owner = np.repeat(np.arange(len(counts)), n_chunks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
    begins = np.cumsum(counts) - counts
    first = begins[owner] + within * STRIDE
    last = begins[owner] + places[owner] - 1
    return np.minimum(first[:, None] + np.arange(CHUNK), last[:, None]), owner


def _responses(net: ByteNetwork, filled: np.ndarray) -> np.ndarray:
    """Every filter at every place; the last block of all has no place."""
    seen = net.embedding[filled].reshape(-1, BLOCK * CHANNELS)
    half = BLOCK * CHANNELS
    return seen[:-1] @ net.filters[:half] + seen[1:] @ net.filters[half:] + net.shift


def pooled_chunks(net: ByteNetwork, filled: np.ndarray, counts: np.ndarray):
    """Largest response per chunk and filter, not below 0, and the chunks' documents."""
    places, owner = chunks_of(counts)
    best = _responses(net, filled)[places].max(axis=1)
    return np.maximum(best, 0), owner


def combine(
    net: ByteNetwork, total: np.ndarray, largest: np.ndarray, n_chunks: np.ndarray
) -> np.ndarray:
    """Probability from the mean and the largest chunk of each document."""
    mean = total / np.maximum(n_chunks, 1)[:, None]
    z = mean @ net.head[:FILTERS] + largest @ net.head[FILTERS:] + net.bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def probabilities(net: ByteNetwork, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of each whole document; a long one is read in parts that overlap as chunks do."""
    n = len(offsets) - 1
    total = np.zeros((n, FILTERS))
    largest = np.zeros((n, FILTERS))
    seen = np.zeros(n)
    for low, high in groups_of_documents(offsets, STEP_BYTES):
        part = data[offsets[low] : offsets[high]]
        cuts = [offsets[low : high + 1] - offsets[low]]
        spans = [(0, len(part))]
        if high == low + 1 and len(part) > PART_BYTES:
            # Each part begins with a chunk and ends with the bytes its last chunk shares.
            tail = BLOCK * (CHUNK - STRIDE + 1)
            spans = [(a, min(a + PART_BYTES + tail, len(part))) for a in range(0, len(part), PART_BYTES)]
            spans = [s for k, s in enumerate(spans) if k == 0 or s[1] - s[0] > tail]
            spans[-1] = (spans[-1][0], len(part))
            cuts = [np.array([0, b - a]) for a, b in spans]
        for (a, b), cut in zip(spans, cuts):
            best, owner = pooled_chunks(net, *blocks_of(part[a:b], cut, b == len(part)))
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rows = low + owner[firsts]
            total[rows] += np.add.reduceat(best, firsts, axis=0)
            largest[rows] = np.maximum(largest[rows], np.maximum.reduceat(best, firsts, axis=0))
            seen[rows] += np.diff(np.r_[firsts, len(owner)])
    return combine(net, total, largest, seen)


def _gradients(net: ByteNetwork, filled, counts, label, weight):
    """Loss gradient of a batch; only the place where a filter peaks in a chunk gets one."""
    places, owner = chunks_of(counts)
    n = len(counts)
    at_places = _responses(net, filled)[places]
    peak = at_places.argmax(axis=1)
    rows = np.arange(len(owner))[:, None]
    raw = at_places[rows, peak, np.arange(FILTERS)]
    best = np.maximum(raw, 0)
    firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    n_chunks = np.diff(np.r_[firsts, len(owner)])
    total = np.add.reduceat(best, firsts, axis=0)
    largest = np.maximum.reduceat(best, firsts, axis=0)
    p = combine(net, total, largest, n_chunks)
    off = ((p - label) * weight).astype(np.float32)
    mean = total / n_chunks[:, None]
    head = np.concatenate([off @ mean, off @ largest]).astype(np.float32)
    down = np.repeat(off / n_chunks, n_chunks)[:, None] * net.head[:FILTERS]
    is_largest = best == np.repeat(largest, n_chunks, axis=0)
    down = down + is_largest * (off[owner][:, None] * net.head[FILTERS:])
    down = np.where(raw > 0, down, 0).astype(np.float32)
    at = places[rows, peak]
    byte_at = at[:, :, None] * BLOCK + np.arange(2 * BLOCK)
    bytes_seen = filled[byte_at]
    seen = net.embedding[bytes_seen].reshape(len(owner), FILTERS, -1)
    filters = np.einsum("cf,cfx->xf", down, seen, optimize=True)
    back = (down[:, :, None] * net.filters.T[None]).reshape(-1, CHANNELS)
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, bytes_seen.reshape(-1), back)
    return [embedding, filters, down.sum(axis=0), head, np.float32(off.sum())]


def fit_network(
    examples: Sequence[tuple[float, bytes]],
    epochs: int = 8,
    batch: int = 32,
    rate: float = 0.01,
    decay: float = 1e-4,
    seed: int = 5,
) -> ByteNetwork:
    """Adam on the logistic loss, with both classes weighing the same."""
    net = ByteNetwork.fresh(seed)
    label = np.array([y for y, _ in examples], np.float32)
    if not len(label) or label.min() == label.max():
        net.head[:] = 0
        share = float(label.mean()) if len(label) else 0.5
        net.bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return net
    weight = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    random = np.random.default_rng(seed)
    state = [[0.0, 0.0] for _ in range(5)]
    names = ["embedding", "filters", "shift", "head", "bias"]
    step = 0
    n_steps = epochs * -(-len(examples) // batch)
    for _ in range(epochs):
        order = random.permutation(len(examples))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            texts = [np.frombuffer(examples[i][1], np.uint8) for i in chosen]
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            filled, counts = blocks_of(np.concatenate(texts), offsets)
            found = _gradients(net, filled, counts, label[chosen], weight[chosen] / len(chosen))
            step += 1
            speed = rate * (1 - 0.9 * step / n_steps)
            for name, gradient, held in zip(names, found, state):
                value = getattr(net, name)
                gradient = gradient + decay * value
                held[0] = 0.9 * held[0] + 0.1 * gradient
                held[1] = 0.99 * held[1] + 0.01 * gradient**2
                move = held[0] / (1 - 0.9**step) / (np.sqrt(held[1] / (1 - 0.99**step)) + 1e-8)
                moved = value - speed * move
                setattr(net, name, float(moved) if name == "bias" else moved.astype(np.float32))
    return net


def train(
    docs: DataFrame, known: DataFrame, per_class: int = PER_CLASS, epochs: int = 8
) -> ByteNetwork:
    """Fit on at most about ``per_class`` whole texts of each label, none over ``TRAIN_BYTES``.

    ``known`` are ``(doc_id, label)``.
    """
    examples = drawn_examples(docs, known, per_class, "quality")
    usable = examples.where(F.octet_length("text").between(1, TRAIN_BYTES))
    found = usable.select("label", F.col("text").cast("binary").alias("raw")).collect()
    pairs = sorted((float(row.label), bytes(row.raw)) for row in found)
    return fit_network(pairs, epochs)


def score(docs: DataFrame, net: ByteNetwork) -> DataFrame:
    """``docs`` with ``score``: the probability that a whole text is of good quality."""
    others = [c for c in docs.columns if c not in ("text", "score")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = probabilities(net, *text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array(found)], names=[*others, "score"]
            )

    shape = StructType([docs.schema[c] for c in others])
    return docs.select(*others, "text").mapInArrow(scored, shape.add("score", "double"))


def quality(docs: DataFrame, labels: DataFrame, accept: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document.

    Learned from rows of ``labels`` whose id is not held out; labels, language, source
    and id are no inputs. A null text scores as an empty one, which the filters see as zero
    bytes; a null id is not held out. Repeated rows are scored each, an empty table
    gives no rows, without labels all score alike. Other columns are ignored.
    """
    net = train(docs, known_labels(labels, "quality"))
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return score(docs.select("doc_id", "text"), net).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= accept).cast("int").alias("predicted")
    )


def without_poor(docs: DataFrame, labels: DataFrame, accept: float = 0.3) -> DataFrame:
    """The documents that score at least ``accept``, with all their columns."""
    net = train(docs, known_labels(labels, "quality"))
    return kept_by_score(docs, lambda rows: score(rows, net), F.col("score") >= accept)
