"""Classes of candidates and the stored band index against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kindred.operators import band_index, banding, classes, documents, similarity
from kindred.operators.components import connected
from kindred.storage import fresh_path, staged

N_HASHES, K = 40, 8


def sentence(draw, n):
    return " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(n))


def corpus(seed=3, n=40):
    """Chains of near copies, exact copies, texts alone and texts without a shingle."""
    draw = random.Random(seed)
    content = {}
    for i in range(n):
        if i % 5 and draw.random() < 0.8:
            words = content[i - 1].split()
            words[draw.randrange(len(words))] = "changed"
            content[i] = " ".join(words)
        else:
            content[i] = sentence(draw, 30)
    content.update({100: content[3], 101: content[3], 102: content[7], 103: "tiny", 104: "", 105: None, 106: "tiny"})
    return content


def as_docs(spark, content):
    return spark.createDataFrame(list(content.items()), "doc_id long, text string")


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    found = connected(spark.createDataFrame(edges, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1300), 1000)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("g,r", [(10, 4), (20, 2)])
def test_classes_equal_listed_pairs(spark, g, r):
    signed = staged(documents.signed_groups(documents.hashed_texts(as_docs(spark, corpus()), N_HASHES, K)), "sig")
    copies = {x.doc_id: x.n_copies for x in signed.collect()}
    rows = staged(banding.band_rows(signed, g, r, N_HASHES), "bands")
    pairs = [(p.x, p.y) for p in similarity.candidate_pairs(rows).collect()]
    root = {d: d for d in copies}
    for _ in copies:
        for x, y in pairs:
            root[x] = root[y] = min(root[x], root[y])
    members, found = classes.candidate_classes(signed, g, r, N_HASHES)
    assert {m.doc_id: m.class_id for m in members.collect()} == root
    expected = {
        (c, sum(v == c for v in root.values()), sum(copies[d] for d in root if root[d] == c), sum(root[x] == c for x, _ in pairs))
        for c in set(root.values())
    }
    assert {tuple(x) for x in found.select("class_id", "n_texts", "n_documents", "n_links").collect()} == expected
    assert max(e[3] for e in expected) > 2 and min(e[1] for e in expected) == 1


@pytest.mark.parametrize("cell_texts", [7, 64, 4096])
def test_links_are_counted_over_blocks_and_shared_cells(spark, cell_texts):
    draw = random.Random(11)
    rows = []
    for class_id, size in [(-5, 1), (0, 2), (10, 3), (1000, 150), (5000, 9)]:
        for i in range(size):
            keys = [class_id * 1000 + draw.randrange(1 + size // 3) for _ in range(4)]
            rows.append((class_id, class_id + i, keys))
    keyed = spark.createDataFrame(rows, "class_id long, doc_id long, keys array<long>")
    sizes = keyed.groupBy("class_id").agg(F.count("*").alias("n_texts"))
    expected = {c: 0 for c in (0, 10, 1000, 5000)}
    for one, other in combinations(rows, 2):
        if one[0] == other[0]:
            expected[one[0]] += any(x == y for x, y in zip(one[2], other[2]))
    found = classes.class_links(keyed, sizes, cell_texts).collect()
    assert len(found) == 4 and {r.class_id: r.n_links for r in found} == expected
    assert classes.class_links(keyed.limit(0), sizes.limit(0), cell_texts).count() == 0


def shingles(text):
    return {text[i : i + K] for i in range(len(text) - K + 1)}


def test_index_is_asked_by_text_and_grows(spark):
    content = corpus()
    index = band_index.BandIndex(fresh_path(spark, "index"), 20, 2, N_HASHES, K, slots=4, files=2)
    ids = sorted(content)
    for part in (ids[:20], ids[20:30], ids[30:]):
        band_index.append(index, as_docs(spark, {d: content[d] for d in part}))
    draw = random.Random(9)
    asked = {1: content[3], 2: content[3] + " and more", 3: sentence(draw, 20), 4: None, 5: "", 6: content[3]}
    queries = spark.createDataFrame(list(asked.items()), "query_id long, text string")
    found = band_index.similar_to_texts(index, queries, as_docs(spark, content), 0.3)
    got = {(r.query_id, r.doc_id): r.sim for r in found.collect()}
    assert len(got) == found.count()

    everything = {("q", q): t for q, t in asked.items()} | {("d", d): t for d, t in content.items()}
    numbered = dict(enumerate(everything))
    texts = as_docs(spark, {i: everything[name] for i, name in numbered.items()})
    rows = banding.band_rows(banding.signatures(texts, N_HASHES, K), 20, 2, N_HASHES).collect()
    buckets = {}
    for r in rows:
        buckets.setdefault((r.band, bytes(r.key)), []).append(numbered[r.doc_id])
    expected = {}
    for members in buckets.values():
        for one, other in combinations(members, 2):
            if one[0] != other[0]:
                (_, q), (_, d) = sorted((one, other), reverse=True)
                x, y = shingles(asked[q]), shingles(content[d])
                if (sim := len(x & y) / len(x | y)) >= 0.3:
                    expected[q, d] = sim
    assert got == pytest.approx(expected) and {(1, 100), (1, 101), (2, 3), (6, 3)} <= set(got)


def test_only_asked_parts_are_read(spark):
    index = band_index.BandIndex(fresh_path(spark, "index"), 20, 2, N_HASHES, K, slots=16)
    band_index.append(index, as_docs(spark, corpus()))
    queries = spark.createDataFrame([(1, corpus()[3])], "query_id long, text string")
    asked = staged(index.placed(index.keyed(queries, "query_id"), "query_id"), "asked")
    parts = {r.part for r in asked.collect()}
    entries = band_index.asked_entries(index, asked)
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [part" in plan
    assert {r.part for r in entries.select("part").distinct().collect()} <= parts
    assert len(parts) <= 20 < index.entries(spark).select("part").distinct().count()
