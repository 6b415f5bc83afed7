from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.functions import minhash, text
from kindred.functions.shingles import shingle_similarity
from kindred.operators import (
    banding,
    cells,
    charsets,
    documents,
    evaluation,
    prefixes,
    sampling,
    similarity,
    skew,
)
from kindred.plans import near_duplicates
from kindred.storage import staged

N_HASHES = 40
few = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def variants(n_groups: int = 6, per_group: int = 4, seed: int = 2) -> dict[int, str]:
    """Groups of texts that differ by a few characters, and some exact copies."""
    rng = random.Random(seed)
    docs, next_id = {}, 0
    for _ in range(n_groups):
        base = "".join(rng.choice("abcdefgh éü😀") for _ in range(120))
        for variant in range(per_group):
            chars = list(base)
            for _ in range(variant * variant):
                chars[rng.randrange(len(chars))] = rng.choice("xyz")
            docs[next_id] = "".join(chars)
            next_id += 1
        docs[next_id] = base
        next_id += 1
    return docs


def as_docs(spark, content):
    rows = list(content.items())
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


def shingles(value: str, k: int = 8) -> set[str]:
    return {value[i : i + k] for i in range(len(value) - k + 1)}


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0


def signature_of(value: str, n_hashes: int = N_HASHES, k: int = 8) -> list[int]:
    """Signature straight from its definition."""
    p = minhash.PRIME
    weights = minhash.place_values(k)
    base = {sum(ord(c) * w for c, w in zip(s, weights, strict=True)) % p for s in shingles(value, k)}
    return [min((a * x + b) % p for x in base) for a, b in minhash.hash_family(n_hashes)]


def test_fixed_point_hashes_are_exact_at_both_ends():
    p, family = minhash.PRIME, minhash.hash_family(200)
    a, b = minhash.fixed_point(family)
    work = np.empty((minhash.CHUNK, len(family)), np.uint64)
    ends = [(t - f[1]) * pow(f[0], -1, p) % p for f in family for t in (0, 1, p - 2, p - 1)]
    for x in [0, 1, p - 1, 2**30, *ends]:
        found = minhash._minima(np.array([x], np.uint64), a, b, work)
        assert found.tolist() == [(f[0] * x + f[1]) % p for f in family]
    several = np.array(ends, np.uint64)
    assert len(several) > minhash.CHUNK
    assert minhash._minima(several, a, b, work).tolist() == [0] * len(family)


def brute_candidates(content, b, r, n_hashes=N_HASHES):
    signed = {d: signature_of(t, n_hashes) for d, t in content.items() if t and len(t) >= 8}
    g = banding.effective_bands(n_hashes, b, r)
    pairs = {}
    for x, y in combinations(sorted(signed), 2):
        shared = sum(
            signed[x][i * r : i * r + r] == signed[y][i * r : i * r + r] for i in range(g)
        )
        if shared:
            pairs[x, y] = shared
    return pairs


@pytest.mark.parametrize("value", ["", "short", "exactly8", "nine char", "😀b😀d😀f😀h😀j", "a\nb\r\ncdefgh"])
def test_ngrams(spark, value):
    row = spark.createDataFrame([(value,)], "text string").select(
        text.ngrams(F.col("text"), 8).alias("full"),
        text.ngrams(F.col("text"), 8, drop_last=True).alias("cut"),
        text.char_set(F.col("text")).alias("chars"),
        text.shingle_set(F.col("text"), 8, keep_empty=True).alias("kept"),
    )
    full, cut, chars, kept = row.first()
    expected = [value[i : i + 8] for i in range(len(value) - 7)]
    assert full == expected
    assert cut == expected[:-1]
    assert set(chars) == set(value) and len(chars) == len(set(value))
    assert set(kept) == (set(expected) or {"special"})


def test_clean_text(spark):
    df = spark.createDataFrame([("  Héllo,\r\n\r\nWORLD_1!! ",)], "text string")
    assert df.select(text.clean_text(F.col("text"))).first()[0] == "héllo world_1"


def test_signatures_follow_their_definition(spark):
    content = {**variants(2, 2), 900: "x" * 3000, 901: "exactly8", 902: "short", 903: None}
    signed = banding.signatures(as_docs(spark, content), N_HASHES)
    got = {r["doc_id"]: r["signature"] for r in signed.collect()}
    assert set(got) == {d for d, t in content.items() if t and len(t) >= 8}
    for doc, signature in got.items():
        assert signature == signature_of(content[doc])


def test_long_text_is_hashed_whole(spark):
    rng = random.Random(4)
    value = "".join(rng.choice("abcdefghij ") for _ in range(5000))
    signed = banding.signatures(as_docs(spark, {1: value}), N_HASHES)
    assert signed.first()["signature"] == signature_of(value)


def test_empty_documents_share_a_sentinel_only_when_kept(spark):
    docs = as_docs(spark, {1: "", 2: "tiny", 3: "exactly8"})
    assert [r["doc_id"] for r in banding.signatures(docs, 20).collect()] == [3]
    kept = {r["doc_id"]: r["signature"] for r in banding.signatures(docs, 20, keep_empty=True).collect()}
    assert kept[1] == kept[2] != kept[3]
    assert banding.signatures(docs, 20, drop_last=True).count() == 0


def test_bands():
    assert banding.effective_bands(200, 50, 20) == 10
    assert banding.effective_bands(200, 20, 10) == 20
    assert banding.effective_bands(200, 20, 10, literal=True) == 19
    with pytest.raises(ValueError):
        banding.effective_bands(200, 20, 7)


@pytest.mark.parametrize("compact", [True, False])
def test_candidates_equal_brute_force(spark, compact):
    content = {d: t for d, t in variants().items()}
    unique = documents.unique_documents(as_docs(spark, content))
    signed = staged(banding.signatures(unique, N_HASHES), "sig")
    rows = banding.band_rows(signed, 10, 4, N_HASHES, compact=compact)
    got = {(r["x"], r["y"]): r["n_bands"] for r in similarity.candidate_pairs(rows).collect()}
    firsts = {}
    for doc in sorted(content):
        firsts.setdefault(content[doc], doc)
    distinct = {d: content[d] for d in firsts.values()}
    assert got == brute_candidates(distinct, 10, 4)


@pytest.mark.parametrize("block_rows", [1, 2, 5, 100])
def test_large_groups_are_cut_into_blocks(spark, block_rows):
    rng = random.Random(block_rows)
    members = sorted({(rng.choice("aaab"), rng.randrange(40)) for _ in range(120)})
    df = spark.createDataFrame(members, "key string, doc_id long")
    found = skew.pairs_sharing_key(df, ["key"], block_rows=block_rows)
    got = {(r["x"], r["y"]): r["n_shared"] for r in found.collect()}
    expected = {}
    for key in "ab":
        for pair in combinations(sorted(d for k, d in members if k == key), 2):
            expected[pair] = expected.get(pair, 0) + 1
    assert got == expected


def test_join_counted_keeps_heavy_and_light_keys(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") < 2500, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    counted = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = skew.join_counted(rows, counted, ["k"], "n")
    assert joined.count() == 5000
    assert joined.where("k = 0 and n = 2500").count() == 2500


@few
@given(st.lists(st.text("abcde", max_size=12), min_size=2, max_size=12), st.sampled_from([0.5, 0.85]))
def test_similar_pairs_by_characters(spark, texts, threshold):
    content = dict(enumerate(texts))
    found = similarity.similar_pairs(as_docs(spark, content), "char", threshold)
    got = {(r["x"], r["y"]): r["sim"] for r in found.collect()}
    sims = {
        (x, y): jaccard(set(content[x]), set(content[y]))
        for x, y in combinations(content, 2)
        if content[x] and content[y]
    }
    assert got == {pair: sim for pair, sim in sims.items() if sim >= threshold}


def test_similar_pairs_by_characters_are_not_shuffled(spark, monkeypatch):
    """Neither meetings nor pairs: each pair leaves the cell of blocks that finds it. Rows may repeat."""

    def never(*args, **kwargs):
        raise AssertionError("pairs are shuffled")

    monkeypatch.setattr(similarity, "pairs_sharing_key", never)
    monkeypatch.setattr(charsets, "LEAST_SETS", 3)
    monkeypatch.setattr(charsets, "BLOCK_SETS", 6)
    rng = random.Random(9)
    rows = [(n % 50, "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", rng.randint(20, 24)))) for n in range(55)]
    docs = spark.createDataFrame([*rows, (60, ""), (None, rows[0][1])], "doc_id long, text string")
    got = sorted((r.x, r.y, r.sim) for r in similarity.similar_pairs(docs, "char", 0.85).collect())
    expected = []
    for (x, a), (y, b) in combinations(rows, 2):
        if x != y and jaccard(set(a), set(b)) >= 0.85:
            expected.append((min(x, y), max(x, y), jaccard(set(a), set(b))))
    assert got == sorted(expected) and len(got) > 20


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.85])
def test_similar_pairs_by_shingles(spark, threshold):
    content = {**variants(5, 5), 900: "tiny", 901: ""}
    found = similarity.similar_pairs(as_docs(spark, content), "shingle", threshold)
    got = {(r["x"], r["y"]): r["sim"] for r in found.collect()}
    expected = {}
    for x, y in combinations(content, 2):
        sim = jaccard(shingles(content[x]), shingles(content[y]))
        if sim >= threshold:
            expected[x, y] = sim
    assert got == expected and got


def test_identical_sets_have_identical_signatures(spark):
    signed = banding.signatures(as_docs(spark, {1: "abcdabcdabcd", 2: "abcdabcdabcdabcd"}), 30)
    first, second = [r["signature"] for r in signed.collect()]
    assert first == second


def lsh_stage(spark, content, b=10, r=4):
    docs = staged(as_docs(spark, content), "docs")
    signed = staged(banding.signatures(documents.unique_documents(docs), N_HASHES), "sig")
    rows = staged(banding.band_rows(signed, b, r, N_HASHES), "bands")
    return docs, signed, rows


def members_of(docs):
    keyed = documents.keyed_texts(docs)
    return documents.copy_members(keyed, documents.copy_groups(keyed))


@pytest.mark.parametrize("domain,exclude", [("char", True), ("shingle", False)])
def test_similar_documents(spark, domain, exclude):
    content = variants()
    docs, _, rows = lsh_stage(spark, content)
    queries = docs.where("doc_id < 12")
    members = members_of(docs)
    found = similarity.similar_documents(
        queries, members, docs, rows, domain, 0.85, exclude_copies=exclude
    )
    got = {(r["doc_id"], r["other_id"]): r["sim"] for r in found.collect()}
    cut = set if domain == "char" else shingles
    expected = {}
    for x, y in brute_candidates(content, 10, 4):
        sim = jaccard(cut(content[x]), cut(content[y]))
        if (0.85 < sim < 1) if exclude else sim >= 0.85:
            expected.update({(p, q): sim for p, q in ((x, y), (y, x)) if p < 12})
    assert got == expected and got


def test_error_rates_equal_brute_force(spark):
    content = {**variants(), 900: "tiny", 901: "tiny", 902: ""}
    docs, signed, rows = lsh_stage(spark, content)
    pairs = similarity.with_similarity(similarity.candidate_pairs(rows), docs, "char")
    counts = evaluation.pair_counts(evaluation.weighted(pairs, signed), signed)
    total = evaluation.similar_char_total(docs).first()["n_similar"]
    row = evaluation.error_rates(
        evaluation.quality(counts), F.lit(total), F.lit(len(content))
    ).first()
    candidates = set(brute_candidates(content, 10, 4))
    sims = {
        (x, y): jaccard(set(content[x]), set(content[y])) for x, y in combinations(content, 2)
    }
    assert row["n_candidates"] == len(candidates)
    assert row["n_over_85"] == sum(sims[p] > 0.85 for p in candidates)
    assert row["n_fp"] == sum(sims[p] < 0.6 for p in candidates)
    assert row["n_fn"] == sum(sims[p] > 0.85 and p not in candidates for p in sims)
    assert row["n_pairs"] == len(sims)


def test_sweep_agrees_with_single_settings(spark):
    content = variants()
    docs, signed, _ = lsh_stage(spark, content)
    swept = evaluation.sweep(
        docs, signed, F.lit(0), F.lit(len(content)), N_HASHES, [(10, 4), (40, 4), (4, 10), (2, 20)]
    )
    got = {(r["b"], r["r"]): (r["n_bands"], r["n_candidates"]) for r in swept.collect()}
    for b, r in got:
        g = banding.effective_bands(N_HASHES, b, r)
        assert got[b, r] == (g, len(brute_candidates(content, b, r)))


def test_set_difference(spark):
    content = {**variants(), 900: "tiny", 901: ""}
    docs, signed, rows = lsh_stage(spark, content)
    row = evaluation.set_difference(docs, similarity.candidate_pairs(rows), signed).first()
    candidates = brute_candidates(content, 10, 4)
    n_filled = sum(bool(t) for t in content.values())
    assert row["n_candidates"] == len(candidates)
    assert row["n_fp"] == 0
    assert row["n_fn"] == n_filled * (n_filled - 1) // 2 - len(candidates)


def test_kept_empty_documents_are_false_positives(spark):
    docs = as_docs(spark, {1: "", 2: "tiny", 3: "some longer text here"})
    unique = documents.unique_documents(docs)
    signed = staged(banding.signatures(unique, N_HASHES, keep_empty=True), "sig")
    pairs = similarity.candidate_pairs(banding.band_rows(signed, 10, 4, N_HASHES))
    row = evaluation.set_difference(docs, pairs, signed).first()
    assert (row["n_candidates"], row["n_fp"], row["n_pairs"]) == (1, 1, 1)


def test_no_candidates_give_null_shares(spark):
    docs, signed, rows = lsh_stage(spark, {1: "the first of two texts", 2: "ANOTHER ONE ENTIRELY"})
    pairs = similarity.with_similarity(similarity.candidate_pairs(rows), docs, "char")
    counts = evaluation.pair_counts(evaluation.weighted(pairs, signed), signed)
    row = evaluation.quality(counts).first()
    assert row["n_candidates"] == 0
    assert row["pct_over_85"] is None and row["cond_1"] is None


def test_sampled_error_rates(spark):
    content = variants(8, 5)
    docs = as_docs(spark, content)
    rates = evaluation.sampled_error_rates(docs, 10, 4, N_HASHES, sample_size=48, n_samples=2)
    candidates = brute_candidates(content, 10, 4)
    sims = {
        (x, y): jaccard(shingles(content[x]), shingles(content[y]))
        for x, y in combinations(content, 2)
    }
    n_fp = sum(sims[p] < 0.85 for p in candidates)
    n_fn = sum(s >= 0.85 and p not in candidates for p, s in sims.items())
    assert n_fp + n_fn > 0
    for row in rates.collect():  # each sample holds all 48 documents
        assert (row["n_docs"], row["n_fp"], row["n_fn"]) == (48, n_fp, n_fn)


def test_run_lsh(spark):
    content = variants(2, 3)
    distinct = {min(d for d in content if content[d] == t): t for t in set(content.values())}
    found = near_duplicates.run_lsh(as_docs(spark, content), 50, 4)
    expected = brute_candidates(distinct, 50, 4, near_duplicates.N_HASHES)
    assert {(r["x"], r["y"]): r["n_bands"] for r in found.collect()} == expected


def test_stages_go_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    stored = staged(spark.range(3), "numbers")
    assert all(f"{folder}/numbers-" in file for file in stored.inputFiles())


def test_latest_line_wins(spark):
    rows = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 7), (2, "only", 3)], "doc_id long, text string, pos long"
    )
    got = documents.latest_per_id(rows, "doc_id", "text", "pos").collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "new", 2: "only"}


def test_s_curve_rises(spark):
    points = evaluation.s_curve(evaluation.s_curve_points(spark), 20, 5).orderBy("s").collect()
    values = [r["p"] for r in points]
    assert len(values) == 99 and values == sorted(values)
    assert next(r["p"] for r in points if r["s"] == 0.6) == pytest.approx(0.8019, abs=1e-4)


def tuned(spark, s1, n_hashes):
    levels = spark.range(1).select(F.lit(s1).alias("s1"), F.lit(0.6).alias("s2"))
    return evaluation.tuning_grid(levels, 50, 50, n_hashes)


def test_tuning(spark):
    for s1 in (0.80, 0.85):
        grid = tuned(spark, s1, 200)
        assert grid.where("feasible").count() == 0
        assert evaluation.best_setting(grid).count() == 1
    grid = tuned(spark, 0.85, 300)
    assert grid.where("feasible").count() == 8
    best = evaluation.best_setting(grid).first()
    assert (best["b"], best["r"]) == (23, 12)
    assert best["p_s1"] == pytest.approx(0.9707, abs=1e-4)
    assert best["p_s2"] == pytest.approx(0.0489, abs=1e-4)


def test_signatures_estimate_similarity(spark):
    rng = random.Random(11)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(600))
    content = {}
    for i in range(40):
        chars = list(base)
        for _ in range(i):
            chars[rng.randrange(len(chars))] = "Z"
        content[i] = "".join(chars)
    signed = banding.signatures(as_docs(spark, content), 200)
    got = {r["doc_id"]: r["signature"] for r in signed.collect()}
    errors = []
    for x, y in combinations(content, 2):
        agree = sum(p == q for p, q in zip(got[x], got[y], strict=True)) / 200
        errors.append(agree - jaccard(shingles(content[x]), shingles(content[y])))
    assert abs(sum(errors) / len(errors)) < 0.03
    assert max(map(abs, errors)) < 0.2


def test_pair_table(spark):
    content = variants(3, 3)
    docs, signed, _ = lsh_stage(spark, content)
    members = members_of(docs)
    pairs = spark.createDataFrame(list(combinations(sorted(content), 2)), "x long, y long")
    table = evaluation.pair_table(pairs, members, signed, 10, 4, N_HASHES).collect()
    candidates = brute_candidates(content, 10, 4)
    assert len(table) == len(content) * (len(content) - 1) // 2
    for row in table:
        assert row["is_candidate"] == ((row["x"], row["y"]) in candidates)
        assert 0 <= row["jaccard"] <= 1 and 0 <= row["cosine_norm"] <= 1


def test_pair_table_equals_brute_force(spark, monkeypatch):
    """Pairs carry signatures alone; these are compared some at a time."""
    monkeypatch.setattr(minhash, "PAIRS", 7)
    content = {**variants(3, 3), 50: "a" * 40, 51: "ab" * 20}
    docs, signed, _ = lsh_stage(spark, content)
    pairs = spark.createDataFrame(list(combinations(sorted(content), 2)), "x long, y long")
    table = evaluation.pair_table(pairs, members_of(docs), signed, 10, 4, N_HASHES)
    assert "md5" not in table._jdf.queryExecution().toString()
    held = {d: signature_of(t) for d, t in content.items()}
    rows = table.collect()
    assert len(rows) == pairs.count()
    for row in rows:
        x, y = held[row.x], held[row.y]
        assert row.jaccard == jaccard(set(x), set(y))
        norms = np.linalg.norm(np.array(x, float)) * np.linalg.norm(np.array(y, float))
        assert row.cosine == pytest.approx(np.dot(np.array(x, float), np.array(y, float)) / norms)
        assert row.is_candidate == any(x[k : k + 4] == y[k : k + 4] for k in range(0, 40, 4))


@pytest.mark.parametrize(("r", "n_bands"), [(10, 20), (4, 10), (1, 3)])
def test_compared_signatures(spark, r, n_bands):
    rng = random.Random(r)
    rows = [[[rng.randint(0, 60) * 30_000_000 for _ in range(200)] for _ in range(2)] for _ in range(30)]
    rows = [(x, x[: 10 * n] + y[10 * n :]) for n, (x, y) in enumerate(rows[:20])] + [tuple(row) for row in rows[20:]]
    pairs = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for row in pairs.select("a", "b", minhash.compared(F.col("a"), F.col("b"), r, n_bands).alias("c")).collect():
        assert row.c.n_shared == len(set(row.a) & set(row.b))
        assert row.c.dot == pytest.approx(sum(float(x) * y for x, y in zip(row.a, row.b, strict=True)))
        bands = range(0, n_bands * r, r)
        assert row.c.is_candidate == any(row.a[k : k + r] == row.b[k : k + r] for k in bands)


def test_draws_of_pairs_are_spread(spark):
    """Adaptive merging of the few bytes of the ids is not to leave all draws to one task."""
    plan = sampling.random_pairs(spark.range(100).withColumnRenamed("id", "doc_id"))._jdf.queryExecution().toString()
    assert "RepartitionByExpression [idx" in plan


def test_set_difference_joins_copies_and_filled_at_once(spark, monkeypatch):
    def never(*args, **kwargs):
        raise AssertionError("pairs are joined once for copies and once more for filled documents")

    monkeypatch.setattr(evaluation, "weighted", never)
    docs = as_docs(spark, {1: "", 2: "tiny", 3: "some longer text", 4: "some longer text", 5: "", 6: "others"})
    unique = documents.unique_documents(docs)
    signed = unique.select("doc_id", "n_copies")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (3, 6)], "x long, y long")
    row = evaluation.set_difference(docs, pairs, signed).first()
    # Texts 1 and 3 have two documents each: 2 + 4 + 2 + 2 pairs and those of both texts' copies; 2 + 2 + 1 in the map.
    assert (row["n_candidates"], row["n_pairs"], row["n_fp"], row["n_fn"]) == (12, 6, 7, 1)
    assert row["fp_rate"] == pytest.approx(7 / 12) and row["fn_rate"] == pytest.approx(1 / 6)


def test_pairs_that_meet_often_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(n, band, bytes([rng.randrange(3)])) for n in range(200) for band in range(6)]
    rows.append((7, 0, bytes([9])))
    rows.append((8, 0, bytes([9])))

    def never(*args, **kwargs):
        raise AssertionError("paired bucket by bucket")

    monkeypatch.setattr(similarity, "pairs_sharing_key", never)
    monkeypatch.setattr(cells, "CELL_ROWS", 50)
    stored = staged(spark.createDataFrame(rows, "doc_id long, band int, key binary"), "bands")
    copies = stored.select("doc_id").distinct().withColumn("n_copies", F.col("doc_id") * 2)
    got = similarity.candidate_pairs(stored, copies).collect()
    keys = {n: {(band, key) for m, band, key in rows if m == n} for n in range(200)}
    expected = {(x, y, len(keys[x] & keys[y]), 2 * x, 2 * y) for x, y in combinations(range(200), 2) if keys[x] & keys[y]}
    assert len(got) == len(expected) and {tuple(row) for row in got} == expected


def test_shingle_similarity_is_exact_for_any_alphabet(spark):
    rng = random.Random(8)
    few_letters, many = "abc", [chr(c) for c in [*range(0x4E00, 0x4E00 + 400), 0x1F600, 0x1F601]]
    rows = [("", "", 0), ("abcdefg", "abcdefgh", 1), (None, "abcdefgh", 2), ("abcdefgh", "abcdefgh", 3)]
    for n in range(4, 40):
        letters = few_letters if n % 2 else many
        one = "".join(rng.choice(letters) for _ in range(200))
        cut = rng.randrange(200)
        rows.append((one, one[:cut] + "!" + one[cut:150] + one, n))
    df = spark.createDataFrame(rows, "x string, y string, n int").repartition(2)
    got = {r.n: r.sim for r in df.select("n", shingle_similarity(F.col("x"), F.col("y"), 8).alias("sim")).collect()}
    assert got == {n: jaccard(shingles(x or ""), shingles(y or "")) for x, y, n in rows}


def test_first_tokens_only_are_shuffled(spark, monkeypatch):
    """Similar pairs are all found from the rarest tokens; the tokens of a text are no rows before that."""
    rng = random.Random(6)
    content = {}
    for group in range(5):
        base = "".join(rng.choice("abcdefghijklmnop") for _ in range(400))
        for n in range(6):
            content[10 * group + n] = base[: 400 - 12 * n] + "".join(rng.choice("xyz") for _ in range(12 * n))
    written = {}

    def kept(df, name):
        stored = staged(df, name)
        written[name] = stored.count()
        return stored

    monkeypatch.setattr(similarity, "staged", kept)
    found = {(r.x, r.y): r.sim for r in similarity.similar_pairs(as_docs(spark, content), "shingle", 0.85).collect()}
    expected = {}
    for x, y in combinations(content, 2):
        sim = jaccard(shingles(content[x]), shingles(content[y]))
        if sim >= 0.85:
            expected[x, y] = sim
    assert found == expected and len(found) > 10
    assert max(written.values()) < 0.25 * sum(len(shingles(t)) for t in content.values())


def test_rare_tokens_are_packed_and_passes_find_the_same(spark):
    """First tokens take a few bytes each, and passes over shares of the tokens lose no similar pair."""
    rng = random.Random(5)
    base = ["".join(rng.choices("abcdefgh ", k=400)) for _ in range(12)]
    content = {
        k: "".join(c if rng.random() > 0.004 * (k % 6) else rng.choice("xyz") for c in base[k % 12]) for k in range(120)
    }
    content |= {500: "short text", 501: "short text!", 502: "", 503: "tiny"}
    docs = as_docs(spark, content).coalesce(2)
    sets = {k: {t[i : i + 8] for i in range(len(t) - 7)} for k, t in content.items()}
    want = {
        (x, y)
        for x in sets
        for y in sets
        if x < y and sets[x] and sets[y] and len(sets[x] & sets[y]) >= 0.85 * len(sets[x] | sets[y])
    }
    assert len(want) > 100

    def tokens(batch):
        return similarity.shingles_of(batch, 8)

    for pass_tokens in (prefixes.PASS_TOKENS, 0):
        close = {(r.x, r.y) for r in prefixes.close_pairs(docs, tokens, 0.85, pass_tokens).collect()}
        assert want <= close
    counts = np.zeros(prefixes.RANGES, np.uint8)
    rows = prefixes.packed_rows(docs, tokens, counts, 0.85, 4).collect()
    n_tokens = sum(len(r.tokens) // 5 for r in rows)
    assert sum(sum(map(len, (r.tokens, r.owners, r.sizes, r.counts))) for r in rows) < 7 * n_tokens
    found = similarity.similar_pairs(docs, "shingle", 0.85)
    assert {(r.x, r.y) for r in found.collect()} == want


def test_similar_pairs_sends_each_text_once_to_its_cell(spark):
    """Texts like one another are compared in one cell, however many pairs they make."""
    pairs = staged(
        spark.createDataFrame([(x, y) for x in range(30) for y in range(x + 1, 30)], "x long, y long"), "clique"
    )
    docs = as_docs(spark, {k: f"text {k}" for k in range(40)})

    def sizes(held, asked):
        return pa.table({"n_rows": [len(held)], "n_pairs": [len(asked)]})

    cells = prefixes.in_shared_cells(pairs, docs, ["text"], 128, sizes, "n_rows long, n_pairs long")
    assert [tuple(r) for r in cells.collect()] == [(30, 435)]
