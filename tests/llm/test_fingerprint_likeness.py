"""Likenesses of stored fingerprints against sets of pieces, also for ties, repeated rows and nulls."""

from __future__ import annotations

import random

import numpy as np
import pytest

from kindred.llm import fingerprints


def text_of(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randrange(1, 8))) for _ in range(n))


def pieces(text):
    return set(fingerprints.ParagraphHasher().digests([text.encode()])[1].tolist())


def plain_likeness(one, other):
    a, b = pieces(one), pieces(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likenesses_equal_those_of_the_sets_of_pieces(spark):
    rows = [(100 + i, text_of(7 * i * i, i)) for i in range(25)]
    rows += [(200 + i, text_of(400, 5) + " " + text_of(i, i)) for i in range(10)]
    rows += [(300, "same line\n" * 500), (301, "same line\n" * 501), (302, ""), (303, None), (304, "\n"), (305, " ")]
    # Rows repeated, and one id with several texts.
    rows += [(400, "twice the same row"), (400, "twice the same row"), (401, "one"), (401, text_of(90, 1))]
    rows += [(None, "no id"), (None, None), (None, text_of(200, 2))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = fingerprints.fingerprints(docs, n_ranges=5).collect()
    assert len(found) == len(rows)

    texts = {fingerprints.printed_of(t or ""): t or "" for _, t in rows}
    ordered = sorted({r[0] for r in rows if r[0] is not None}, reverse=True)
    for r in found:
        own = texts[r.fingerprint]
        assert r.near_edited == pytest.approx(fingerprints.fingerprint_likeness(r.fingerprint, r.edited_fingerprint))
        if r.doc_id is None or r.doc_id >= 400 or r.doc_id == ordered[-1]:
            continue
        following = ordered[ordered.index(r.doc_id) + 1]
        (after,) = [t or "" for i, t in rows if i == following]
        assert r.near_edited == pytest.approx(plain_likeness(own, fingerprints.edited(own, after)))
        assert r.near_next == pytest.approx(plain_likeness(own, after))
    # Rows of one id follow each other by their texts' hash; a repeated row is followed by its like.
    assert sorted(r.near_next == 1.0 for r in found if r.doc_id == 400) == [False, True]
    assert sorted(r.n_chars for r in found if r.doc_id is None) == [0, 5, len(text_of(200, 2))]


def test_stored_sketches_come_apart_and_fold():
    draw = np.random.default_rng(4)
    for n in (0, 1, 9, 10, 11, 80, 3000):
        key = draw.integers(0, 2**63, n, dtype=np.uint64)
        (cells,) = fingerprints.stored_cells(1, np.zeros(n, np.int64), key)
        assert sorted(fingerprints.recovered([cells])[1].tolist()) == sorted(key.tolist())
        small = fingerprints.Sketches(np.array([5]), 0)
        small.add(np.zeros(n, np.int64), key, 1)
        assert (fingerprints.folded(cells, 5) == small.packed()).all()
        for m in (0, 3, 40, 900):
            other = np.concatenate([key[m // 2 :], draw.integers(0, 2**63, m, dtype=np.uint64)])
            (others,) = fingerprints.stored_cells(1, np.zeros(len(other), np.int64), other)
            _, found, side = fingerprints.stored_differences([cells], [others])
            assert sorted(zip(found.tolist(), side.tolist())) == sorted(
                [(k, 1) for k in key[: m // 2].tolist()] + [(k, -1) for k in other[len(key[m // 2 :]) :].tolist()]
            )
