"""Character sets as bits, and sums over pairs without a list of them, against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kindred.functions import charset
from kindred.operators import banding, cells, charsets, documents, evaluation, similarity, skew
from kindred.storage import staged


def texts(n=60, seed=1):
    """Texts near to one another, of a few frequent and of many rare characters, and copies."""
    draw = random.Random(seed)
    rare = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    common = "abcdefghijklmnopqrstuvwxyz ,."
    content = {}
    for i in range(n):
        base = draw.sample(common, 20) + draw.sample(rare, 40) if i % 3 == 0 else list(content[i - 1])
        for _ in range(draw.randint(0, 4)):
            base[draw.randrange(len(base))] = draw.choice(rare + list(common))
        content[i] = "".join(base)
    content.update({n: "", n + 1: "🙂", n + 2: content[0], n + 3: content[0][::-1], n + 4: None})
    return content


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 0.0


def as_docs(spark, content):
    return spark.createDataFrame(list(content.items()), "doc_id long, text string")


def test_sets_hold_the_characters(spark):
    content = texts()
    docs = as_docs(spark, content).withColumn("chars", charset.characters(F.col("text")))
    sets = charsets.char_sets(docs)
    rows = charsets.with_sets(docs, sets).collect()
    assert {r.doc_id for r in rows} == {d for d, t in content.items() if t}
    assert any(r.rest for r in rows) and all(r.size == len(set(content[r.doc_id])) for r in rows)
    described = charsets.with_sets(docs, sets)
    filled = sorted(r.doc_id for r in rows)
    pairs = spark.createDataFrame(list(combinations(filled, 2)), "x long, y long")
    found = charsets.with_char_similarity(pairs, described).collect()
    assert len(found) == len(filled) * (len(filled) - 1) // 2
    for r in found:
        assert r.sim == pytest.approx(jaccard(set(content[r.x]), set(content[r.y])))


def test_similar_total_equals_all_pairs(spark):
    for seed in (1, 2, 3):
        content = texts(seed=seed)
        sims = [
            jaccard(set(content[x]), set(content[y]))
            for x, y in combinations([d for d, t in content.items() if t], 2)
        ]
        expected = sum(s > evaluation.SIMILAR for s in sims)
        assert evaluation.similar_char_total(as_docs(spark, content)).first()["n_similar"] == expected > 3


def test_candidate_counts_equal_listed_pairs(spark):
    content = {**texts(), 500: "tiny", 501: "tiny"}
    docs = as_docs(spark, content)
    signed = staged(documents.signed_groups(documents.hashed_texts(docs, 40, 4)), "sig")
    sets = charsets.char_sets(signed)
    cuts = [(10, 4), (20, 2), (40, 1)]
    got = {r.cut: r for r in evaluation.candidate_counts(signed, sets, cuts, 40, by=["cut"]).collect()}
    for g, r in cuts:
        pairs = similarity.candidate_pairs(staged(banding.band_rows(signed, g, r, 40), "bands"))
        scored = similarity.with_similarity(pairs, docs, "char")
        listed = evaluation.pair_counts(evaluation.weighted(scored, signed), signed).first()
        assert listed.n_candidates > 1
        for name in ("n_candidates", "n_over_85", "n_under_60"):
            assert got[f"{g}x{r}"][name] == listed[name], (g, r, name)


@pytest.mark.parametrize("block_rows", [1, 3, 100])
def test_sums_of_pairs_count_each_pair_once(spark, block_rows):
    draw = random.Random(4)
    held = {i: sorted(draw.sample("abcdef", draw.randint(1, 4))) for i in range(50)}
    rows = [(i, k, held[i], i % 2) for i, keys in held.items() for k in keys]
    members = spark.createDataFrame(rows, "doc_id long, key string, held array<string>, n long")
    found = skew.sums_of_pairs(
        members,
        ["key"],
        lambda a, b: [F.count("*").alias("pairs"), F.sum(a("n") * b("n")).alias("both_odd")],
        lambda a, b: F.array_min(F.array_intersect(a("held"), b("held"))) == F.col("key"),
        carry=["held", "n"],
        block_rows=block_rows,
    ).first()
    sharing = [(x, y) for x, y in combinations(held, 2) if set(held[x]) & set(held[y])]
    assert (found.pairs, found.both_odd) == (len(sharing), sum(x % 2 * (y % 2) for x, y in sharing))


def test_no_documents_give_zero(spark):
    docs = as_docs(spark, {1: "", 2: None})
    assert evaluation.similar_char_total(docs).first()["n_similar"] == 0


def test_counts_where_documents_meet_often(spark, monkeypatch):
    """Compared in cells of two blocks: no bucket carries keys, and the sums are those of brute force."""
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    base = "".join(rng.choice(letters) for _ in range(300))
    content = {n: base[: 150 + n] + "".join(rng.choice(letters) for _ in range(n % 60)) for n in range(150)}
    docs = spark.createDataFrame(list(content.items()), "doc_id long, text string")
    signed = staged(
        documents.signed_groups(documents.hashed_texts(docs, 40, 8)).withColumn("n_copies", F.col("doc_id") + 1),
        "signed",
    )

    def never(*args, **kwargs):
        raise AssertionError("summed up bucket by bucket")

    monkeypatch.setattr(evaluation, "sums_of_pairs", never)
    monkeypatch.setattr(cells, "CELL_ROWS", 40)
    got = evaluation.candidate_counts(signed, charsets.char_sets(signed), [(20, 2)], 40).first()
    signatures = {row.doc_id: row.signature for row in signed.collect()}
    expected = [sum((n + 1) * n // 2 for n in signatures)] * 2 + [0]
    for x, y in combinations(sorted(signatures), 2):
        a, b = signatures[x], signatures[y]
        if any(a[k : k + 2] == b[k : k + 2] for k in range(0, 40, 2)):
            one, other = set(content[x]), set(content[y])
            sim, weight = len(one & other) / len(one | other), (x + 1) * (y + 1)
            for k, counted in enumerate((True, sim > 0.85, sim < 0.6)):
                expected[k] += weight * counted
    assert [int(n) for n in got] == expected and min(expected) > 0


def test_blocks_of_sets_are_bounded_and_meet_once():
    counts = [(size, 1 + 200_000 * size % 90_000) for size in range(5, 80)] + [(3000, 5000), (10**6, 3)]
    places, reach = charsets.size_blocks(counts, 0.85)
    held = {}
    for (size, n), (same, first, parts) in zip(counts, places, strict=True):
        assert size == same
        for block in range(first, first + parts):
            held.setdefault(block, []).append((size, -(-n // parts)))
    assert sorted(held) == [block for block, _, _ in reach] == list(range(len(held)))
    for rows in held.values():
        n = sum(n for _, n in rows)
        assert n <= charsets.BLOCK_SETS and (n == 1 or n * rows[-1][0] <= charsets.BLOCK_CHARACTERS)
    to = {block: (low, high) for block, low, high in reach}
    for a, b in combinations(held, 2):
        allowed = held[b][0][0] * 0.85 <= held[a][-1][0]
        assert (to[a][0] <= b <= to[a][1]) == (to[b][0] <= a <= to[b][1]) == allowed


def test_similar_total_over_many_blocks(spark, monkeypatch):
    """Cells of few sets, some of only rare characters, sum up what brute force does."""
    monkeypatch.setattr(charsets, "LEAST_SETS", 4)
    monkeypatch.setattr(charsets, "BLOCK_SETS", 7)
    monkeypatch.setattr(charset, "TILE", 16)
    draw = random.Random(8)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]
    content = texts(seed=6)
    for n in range(100, 180):
        near = letters[n % 5 * 100 : n % 5 * 100 + 90]
        content[n] = "".join(near[draw.randint(0, 6) : draw.randint(84, 90)] + draw.sample(letters, draw.randint(0, 3)))
    filled = {d: set(t) for d, t in content.items() if t}
    expected = sum(jaccard(x, y) > 0.85 for x, y in combinations(filled.values(), 2))
    assert evaluation.similar_char_total(as_docs(spark, content)).first()["n_similar"] == expected > 100
