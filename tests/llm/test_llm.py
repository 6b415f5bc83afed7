"""Operators for training data: small tables with nulls, ties, repeats, empty and long texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import (
    decontamination,
    fingerprints,
    jaccard_join,
    language,
    license_scan,
    mixing,
    quality,
    textbytes,
    token_counts,
    toxicity,
    warc,
)
from kindred.operators import components
from kindred.llm.labelled import drawn_examples

DOCS = "doc_id long, text string, lang string, source string, score double, label string, n long, key string"


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source), with other columns whose names operators use too."""
    return spark.createDataFrame([(*r, 0.5, "x", 7, "k") for r in rows], DOCS)


def words(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))


def odd_rows():
    long = words(30_000, 1)
    near = words(60, 2)
    return [
        (1, near, "en", "a"),
        (2, near, "en", "a"),
        (2, near, "en", "a"),
        (3, near + " tail", "en", None),
        (4, "", "de", "b"),
        (5, None, None, "b"),
        (None, near, "en", None),
        (None, None, "de", "c"),
        (6, long, "de", "c"),
        (7, "one", "fr", "c"),
        (8, "ONE", "fr", "é"),
        (9, " \n\t ", "fr", "é"),
    ]


def test_words_and_shingles_follow_their_patterns():
    import pyarrow as pa

    texts = ["Ab c\tD é", "", None, " x ", words(40, 3), "a b c d e f"]
    hasher = textbytes.WordHasher()
    seen = {}
    for low, high, hashes, owner in hasher.words(pa.array(texts)):
        for k, text in enumerate(texts[low:high]):
            found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            mine = hashes[owner == k]
            assert len(mine) == len(found)
            for word, value in zip(found, mine.tolist()):
                lowered = "".join(c.lower() if c.isascii() else c for c in word)
                assert seen.setdefault(lowered, value) == value
    assert len(set(seen.values())) == len(seen)


def test_long_text_in_pieces_has_the_same_words(monkeypatch):
    import pyarrow as pa

    column = pa.array([words(500, 4), "short one", words(300, 5)])
    whole = [h.tolist() for _, _, h, _ in textbytes.WordHasher().words(column)]
    monkeypatch.setattr(textbytes, "PIECE", 200)
    parts = [h.tolist() for _, _, h, _ in textbytes.WordHasher().words(column)]
    assert sum(whole, []) == sum(parts, [])


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), None, None if i % 11 == 0 else "abc"[i % 3]) for i in range(600)]
    mixed = mixing.mix(documents(spark, rows + odd_rows())).collect()
    assert len(mixed) == len(rows) + len(odd_rows())
    by_source = {}
    for r in mixed:
        assert r.taken == r.repetitions * r.size <= 3 * r.size
        by_source.setdefault(r.source, []).append(r)
    for group in by_source.values():
        most = max(r.size for r in group)
        assert abs(sum(r.taken for r in group) - group[0].target) <= most
        assert group[0].target <= 3 * group[0].source_size + 1e-6
    assert sum(g[0].target for g in by_source.values()) == pytest.approx(sum(r.size for r in mixed))
    assert mixing.mix(documents(spark, [])).count() == 0


def test_water_filling_reaches_the_level_of_repeated_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 40, "d": 3, "e": 500}
    filled = mixing.water_fill(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r.source: r.target for r in filled.collect()}
    weight = dict(zip(sorted(sizes), [5, 2, 1, 5, 2]))
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * w / open_weight for s, w in weight.items()}
        over = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    assert got == pytest.approx(target)


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets.append({tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        ((r[0], len(sets[i]), least.get(root(i))) for i, r in enumerate(rows)), key=str
    )


def test_jaccard_join_equals_all_pairs(spark):
    draw = random.Random(9)
    rows = odd_rows()
    for group in range(12):
        base = words(draw.choice([6, 9, 14, 25, 60, 150]), 100 + group).split()
        for _ in range(14):
            copy = list(base)
            for _ in range(draw.randrange(0, 1 + len(base) // 18)):
                copy[draw.randrange(len(copy))] = words(1, draw.random())
            if draw.random() < 0.4:
                copy = copy[draw.randrange(3) :] + words(draw.randrange(1, 4), draw.random()).split()
            rows.append((len(rows) + 100, " ".join(copy), "en", "a"))
    passage = words(40, 77)
    rows += [(1000 + i, f"{passage} {words(20, 500 + i)}", "en", "a") for i in range(40)]
    found = jaccard_join.near_duplicates(documents(spark, rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == brute_components(rows)


def test_similar_sets_always_share_a_signature():
    random_numbers = np.random.default_rng(4)
    common = random_numbers.integers(0, 1 << 52, 30, dtype=np.uint64)
    for frequent in (np.empty(0, np.uint64), common):
        signer = jaccard_join.Signer(frequent)
        for size in [4, 5, 7, 8, 13, 29, 64, 143, 500]:
            for _ in range(25):
                base = np.unique(random_numbers.integers(0, 1 << 52, size, dtype=np.uint64))
                if len(frequent):
                    base = np.unique(np.concatenate([base[: size // 2], frequent[: size // 2]]))
                # The most that may be left out and put in at a similarity of 3/4.
                out = random_numbers.integers(0, len(base) // 4 + 1)
                kept = random_numbers.permutation(base)[out:]
                extra = max(int(len(kept) / 0.75) - len(base), 0)
                other = np.unique(
                    np.concatenate([kept, random_numbers.integers(0, 1 << 52, extra, dtype=np.uint64)])
                )
                both = len(np.intersect1d(base, other))
                if np.array_equal(base, other) or 100 * both < 75 * (len(base) + len(other) - both):
                    continue
                number, owner = signer.sign(
                    np.concatenate([base, other]), np.array([len(base), len(other)])
                )
                assert set(number[owner == 0]) & set(number[owner == 1])


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, odd_rows())
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    # 1 stands for all near copies; texts without words all stay.
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(["1", "4", "5", "None", "6", "7", "9"])


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_contamination_equals_brute_force(spark):
    item, short = words(20, 11), "tiny item here"
    items = spark.createDataFrame(
        [(1, item), (2, short), (3, ""), (4, None), (5, "x y"), (6, item)], "item_id long, text string"
    )
    rows = odd_rows() + [
        (20, words(30, 12) + " " + item.upper() + " " + item, "en", "a"),
        (21, "see tiny-item here; tiny item", "en", "a"),
        (22, words(400, 13) + " tiny item here", "en", "a"),
        (23, " ".join(item.split()[:12]), "en", "a"),
        (24, "x! y", "en", "a"),
    ]
    found = decontamination.contamination(documents(spark, rows), items).collect()

    def cut(text):
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    expected = []
    for doc_id, text, *_ in rows:
        w, hit, names = cut(text), set(), set()
        for name, other in ((1, item), (2, short), (5, "x y"), (6, item)):
            v = cut(other)
            n = min(len(v), 13)
            for k in range(len(v) - n + 1):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == v[k : k + n]:
                        hit.update(range(at, at + n))
                        names.add(str(name))
        expected.append((doc_id, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert any(e[4] for e in expected) and any(e[2] and not e[4] for e in expected)
    docs = documents(spark, rows)
    assert decontamination.decontaminated(docs, items).count() == sum(not e[4] for e in expected)
    assert decontamination.decontaminated(docs, items.limit(0)).count() == len(rows)
    assert decontamination.contamination(docs.limit(0), items).count() == 0


def test_token_counts_of_chunks_equal_those_of_whole_texts(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    small = token_counts.ChunkedCounter(path, chunk=200, overlap=16)
    assert small.splits_at_spaces
    texts = [
        words(500, 21),
        "ünïcode 世界 " * 100,
        "nospace" * 300,
        "a  b\n\n c\t" * 200,
        "<s> </s> ▁ x " * 60,
        "x" * 1000 + " " + words(200, 22),
    ]
    for text in texts:
        assert small.count(text) == len(small.model.encode(text))
    assert small._spliced(texts[0].encode()) == len(small.model.encode(texts[0]))
    rows = odd_rows()
    got = token_counts.token_counts(documents(spark, rows), path, chunk=1000).collect()
    expected = [
        (r[0], len((r[1] or "").encode()), n := len(small.model.encode(r[1] or "")), n > 4096) for r in rows
    ]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_fingerprints_are_inverted_and_follow_the_next_document(spark):
    rows = [r for r in odd_rows() if r[0] != 2] + [(30 + i, words(5 * i, i), "en", "a") for i in range(40)]
    found = fingerprints.fingerprints(documents(spark, rows), n_ranges=7).collect()
    assert len(found) == len(rows)
    known = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for (doc_id, text, *_), (_, following, *_) in zip(known, known[1:]):
        edited = fingerprints.edited(text or "", following or "")
        assert by_id[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[doc_id].n_chars == len(text or "")
    long = by_id[69]
    assert long.near_edited > 0.3 > long.near_next
    hasher = fingerprints.ParagraphHasher()
    a, b = "one line\ntwo lines\nthree\n", "one line\ntwo lines\nfour\n"
    owner, key = hasher.digests([a.encode(), b.encode()])
    sketches = fingerprints.printed(np.bincount(owner), fingerprints.stored_cells(2, owner, key))
    differing = fingerprints.differing_digests(*sketches)
    one, other = set(key[owner == 0].tolist()), set(key[owner == 1].tolist())
    assert {k for k, _ in differing} == one ^ other and {s for _, s in differing} == {1, -1}
    assert fingerprints.fingerprints(documents(spark, [])).count() == 0
    alone = fingerprints.fingerprints(documents(spark, [(1, "only one\n", "en", "a")])).first()
    assert alone.near_next == 1.0


def test_differences_are_found_whatever_their_number():
    random_numbers = np.random.default_rng(3)
    for n in (0, 1, 5, 60, 900):
        left = random_numbers.integers(0, 2**63, 50 + n, dtype=np.uint64)
        right = left[n:]
        owner = lambda k: np.zeros(len(k), np.int64)
        pair, key, side = fingerprints.differences(1, (owner(left), left), (owner(right), right))
        assert sorted(key.tolist()) == sorted(left[:n].tolist()) and set(side.tolist()) <= {1}


def test_copies_and_heavy_signatures_are_split(spark):
    near = words(80, 11)
    none = np.empty(0, np.uint64)

    def signatures(packed):
        return [(r.bucket, len(r.signatures) // 5) for r in packed.collect()]

    one = documents(spark, [(0, near, "en", "a")]).coalesce(1)
    copies = documents(spark, [(k, near, "en", "a") for k in range(500)]).coalesce(1)
    n_one = sum(n for _, n in signatures(jaccard_join.signature_rows(one, none, 4)))
    assert sum(n for _, n in signatures(jaccard_join.signature_rows(copies, none, 4))) == n_one

    rows = [(k, f"{near} {words(1, 1000 + k)}", "en", "a") for k in range(300)]
    rows += [(1000 + k, words(80, 5000 + k), "en", "a") for k in range(100)]
    rows += [(2000 + k, f"{words(40, 12)} {words(45, 7000 + k)}", "en", "a") for k in range(50)]
    docs = documents(spark, rows)
    heavy = jaccard_join.heavy_signatures(docs, none, len(rows), heavy_sets=40)
    assert len(heavy) > 0
    whole = signatures(jaccard_join.signature_rows(docs, none, 1))
    split = signatures(jaccard_join.signature_rows(docs, none, 1, heavy=heavy, n_blocks=12))
    total, largest = {}, {}
    for into, found in ((total, whole), (largest, split)):
        for bucket, n in found:
            into[bucket] = into.get(bucket, 0) + n
    assert sum(largest.values()) == sum(total.values())
    assert sum(n for bucket, n in largest.items() if bucket) > 200 * 20
    assert max(n for bucket, n in largest.items() if bucket) < sum(total.values()) / 6

    got = [
        {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
        for found in (
            jaccard_join.near_duplicates(docs),
            jaccard_join.near_duplicates(docs, heavy_sets=40),
        )
    ]
    assert got[0] == got[1]
    assert {got[1][k][1] for k in range(300)} == {0}
    assert all(got[1][1000 + k][1] == 1000 + k for k in range(100))


def test_signatures_in_passes_find_the_same(spark):
    """Passes deal disjoint parts of the buckets, and what they find together is the same."""
    none = np.empty(0, np.uint64)
    rows = [(k, f"{words(60, 11)} {words(1 + k % 9, 1000 + k)}", "en", "a") for k in range(60)]
    rows += [(100 + k, words(50, 5000 + k // 2) + " x" * (k % 2), "en", "a") for k in range(40)]
    rows += [(None, words(60, 11), "en", "a"), (7, None, "en", "a"), (7, "", "en", "a")]
    docs = documents(spark, rows).coalesce(1)

    def signatures(turn, n_passes):
        packed = jaccard_join.signature_rows(docs, none, 8, turn=turn, n_passes=n_passes)
        found = [(r.bucket, bytes(r.signatures)) for r in packed.collect()]
        return sorted(found), {bucket for bucket, _ in found}

    whole, buckets = signatures(0, 1)
    parts = [signatures(turn, 2) for turn in range(2)]
    assert sorted(parts[0][0] + parts[1][0]) == whole
    assert not parts[0][1] & parts[1][1] and parts[0][1] | parts[1][1] == buckets
    assert max(sum(len(s) for _, s in part) for part, _ in parts) < 0.7 * sum(len(s) for _, s in whole)

    results = [
        sorted(map(str, jaccard_join.near_duplicates(docs, **more).drop("component").collect()))
        for more in ({}, {"pass_elements": 0}, {"pass_elements": 0, "heavy_sets": 20})
    ]
    assert len(results[0]) == len(rows)
    assert results[0] == results[1] == results[2]


def test_one_of_each_shuffles_texts_once(spark):
    rows = [(1, "a b c d e f", "en", "a"), (1, "a b c d e f", "en", "a"), (None, "g h i j k l", "en", "a")]
    rows += [(0, "g h i j k l m", "en", "a"), (2, "", "en", "a"), (2, "", "en", "a"), (None, None, "en", "a")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join.one_of_each(documents(spark, rows))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    window = plan[plan.index("Window") :]
    assert "Exchange" not in window[: window.index("Join")]
    kept = sorted((str(r.doc_id), r.text) for r in found.collect() if r.text)
    assert kept == [("0", "g h i j k l m"), ("1", "a b c d e f"), ("None", "g h i j k l")]
    assert sum(1 for r in found.collect() if not r.text) == 3


def test_license_rules_need_their_sentences_in_order(spark):
    mit = ["The MIT License", "x", license_scan.SENTENCES["mit-notice"]]
    rows = [
        (1, "Hello. Released under the MIT License. Bye", "en", "a"),
        (2, ".\n".join(mit), "en", "a"),
        (3, ".\n".join(mit[::-1]), "en", "a"),
        (4, "\n".join([mit[0], "a", "b", "c", "d", mit[2]]), "en", "a"),
        (5, "Licensed under the Apache License, Version 2.0! all rights reserved.\n" * 3, "en", "a"),
        (6, None, "en", "a"),
        (7, "", "en", "a"),
        (None, "Released under the MIT license", "en", "a"),
        (None, "Released under the MIT license", "en", "a"),
    ]
    found = license_scan.scan(documents(spark, rows)).collect()
    got = sorted(((r.doc_id, r.n_matches, r.licenses) for r in found), key=str)
    expected = [
        (1, 1, ["MIT"]),
        (2, 1, ["MIT"]),
        (3, 0, []),
        (4, 0, []),
        (5, 6, ["All-Rights-Reserved", "Apache-2.0"]),
        (6, 0, []),
        (7, 0, []),
        (None, 1, ["MIT"]),
        (None, 1, ["MIT"]),
    ]
    assert got == sorted(expected, key=str)
    assert license_scan.scan(documents(spark, [])).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""

BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""

GPL_TEXT = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def commented(text, mark, before="", after=""):
    return before + "".join(f"{mark} {line}".rstrip() + "\n" for line in text.split("\n")) + after


def test_license_notices_match_when_wrapped(spark):
    notice = MIT_TEXT.split("\n\n")[-1]
    rows = [
        (1, MIT_TEXT, "en", "a"),
        (2, BSD_TEXT, "en", "a"),
        (3, GPL_TEXT, "en", "a"),
        (4, commented(MIT_TEXT, "#"), "en", "a"),
        (5, commented(BSD_TEXT, " *", "/*\n", " */\nint x;\n"), "en", "a"),
        (6, commented(GPL_TEXT, "//").replace("\n", "\r\n"), "en", "a"),
        (7, "The MIT License\n" + notice, "en", "a"),
        (8, MIT_TEXT.replace("all\ncopies", "all\n\ncopies"), "en", "a"),
        (9, MIT_TEXT.replace("portions", "parts"), "en", "a"),
        (10, MIT_TEXT.replace("of the Software.", "of the Software\nand more."), "en", "a"),
        (11, MIT_TEXT.replace("of the Software.", "of the Software and more."), "en", "a"),
    ]
    found = license_scan.scan(documents(spark, rows)).collect()
    got = {r.doc_id: ",".join(r.licenses) for r in found}
    expected = ["MIT", "BSD-2-Clause", "GPL-3.0", "MIT", "BSD-2-Clause", "GPL-3.0", "MIT", "", "", "MIT", ""]
    assert got == dict(enumerate(expected, 1))


def test_license_table_covers_the_common_licenses(spark):
    source, binary = (license_scan.SENTENCES[k] for k in ("bsd-source", "bsd-binary"))
    endorse = "derived from this software without specific prior written permission."
    three = (
        "3. Neither the name of the {} nor the names of its\n   contributors may be used to endorse or "
        f"promote products {endorse}"
    )
    advert = (
        "3. All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement:\n   This product includes software developed by the Example Project.\n"
    )
    bsd2 = f"1. {source}.\n2. {binary}.\n"
    gpl2 = GPL_TEXT.replace("version 3", "version 2")
    lgpl21 = GPL_TEXT.replace("This program is free", "This library is free")
    lgpl21 = lgpl21.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL"
    isc = (
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee "
        "is hereby granted"
    )
    cases = [
        (bsd2 + three.format("copyright holder"), "BSD-3-Clause"),
        (bsd2 + three.format("Example\n   Foundation").replace("3. ", " * "), "BSD-3-Clause"),
        (bsd2 + three.format("Example Inc.") + "\n", "BSD-3-Clause"),
        (bsd2 + "THIS SOFTWARE IS PROVIDED", "BSD-2-Clause"),
        (bsd2 + "\nx.\n" * 9 + three.format("copyright holder"), "BSD-2-Clause"),
        (bsd2 + advert + three.format("University").replace("3. ", "4. "), "BSD-4-Clause"),
        (bsd2 + three.format("author") + "\n\n" + "Other text.\n" * 9 + bsd2, "BSD-2-Clause,BSD-3-Clause"),
        (gpl2, "GPL-2.0"),
        (lgpl21, "LGPL-2.1"),
        (GPL_TEXT.replace("General Public License as", "Affero General Public License as"), "AGPL-3.0"),
        (mpl, "MPL-2.0"),
        (isc + ", provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
        (isc + ".", "0BSD"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later\nint x;", "GPL-2.0"),
        ("/* SPDX-License-Identifier: BSD-3-Clause */", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"),
        ("# SPDX-License-Identifier: Unknown-1.0", ""),
    ]
    rows = [(k, text, "en", "a") for k, (text, _) in enumerate(cases)]
    found = license_scan.scan(documents(spark, rows)).collect()
    got = {r.doc_id: ",".join(r.licenses) for r in found}
    assert got == {k: names for k, (_, names) in enumerate(cases)}


def test_archives_hold_repeats_once(spark):
    same, other = "x" * 150 + "\r\n\r\nWARC/1.1\r\n", "é" * 60
    rows = [
        (5, "http://a/\r\nb", same, 1),
        (3, None, same, 1),
        (3, None, same, 1),
        (None, "u", same, 1),
        (7, "u", "short", 1),
        (8, "u", "short", 1),
        (9, "u", None, 1),
        (10, "u", other, 1),
        (11, "u", other, 1),
        (None, "u", "z" * 200, 1),
        (None, "u", "z" * 200, 1),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = warc.archived(pages).collect()
    expected = []
    for page_id, _, html, _ in rows:
        raw = (html or "").encode()
        first = min((r[0] for r in rows if r[2] == html and r[0] is not None), default=None)
        again = len(raw) >= 100 and first is not None and page_id != first
        kind = "revisit" if again else "response"
        expected.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), kind, first if again else None))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert warc.archived(pages.limit(0)).count() == 0


def labelled(spark, marked, plain, column):
    rows, labels = [], []
    for i in range(100, 500):
        bad = i % 3 == 0
        rows.append((i, (marked if bad else plain)(i), "en", "a"))
        labels.append((i, int(bad)))
    return documents(spark, rows + odd_rows()), spark.createDataFrame(labels, f"doc_id long, {column} int")


def test_toxicity_learns_words_and_not_groups(spark):
    draw = random.Random(5)
    groups = ["women", "gay", "muslim", "black"]

    def toxic(i):
        return f"{words(20, i)} you idiot {draw.choice(groups)} people. {words(10, -i)}"

    docs, labels = labelled(spark, toxic, lambda i: words(30, 1000 + i), "toxic")
    scored = toxicity.toxicity(docs, labels)
    truth = scored.join(labels, "doc_id").where("held_out").collect()
    assert truth and all(r.predicted == r.toxic for r in truth)
    assert scored.count() == docs.count() and scored.where("score is null").count() == 0
    known = toxicity.known_labels(labels, "toxic")
    neutral = documents(spark, [(1, "gay people met.", "en", "a"), (2, "women met.", "en", "a")])
    pulls = [
        max(r.score for r in toxicity.score(neutral, toxicity.train(docs, known, penalty=p)).collect())
        for p in (0.0, 50.0)
    ]
    assert pulls[1] <= pulls[0]
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert toxicity.toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_swaps_are_drawn_from_the_whole_text():
    term = toxicity.IDENTITY_TERMS[0][0]
    text = "\n".join(f"n{k} {term} x." for k in range(200))
    found = [one for one, _ in toxicity.counterfactual_sentences(text)]
    at = [int(one.split(" ")[0][1:]) for one in found]
    assert len(set(at)) == toxicity.SWAPS_PER_DOC and at == sorted(at) and at[-1] >= 100
    assert found == [one for one, _ in toxicity.counterfactual_sentences(text)]
    few = list(toxicity.counterfactual_sentences(f"A {term} b. None. C {term}."))
    assert [one for one, _ in few] == [f"A {term} b.", f"C {term}."]
    assert all(one != other for one, other in few)


def test_an_id_of_many_rows_is_drawn_once(spark):
    rows = [(k % 3, text, "en", "a") for k in range(300) for text in ("same", "longer", "", None)]
    rows += [(7, "other", "en", "a"), (8, None, "en", "a"), (None, "none", "en", "a")]
    marks = [(k, k % 2) for k in (0, 1, 2, 7, 8, 9)] + [(1, 0)]
    known = spark.createDataFrame(marks, "doc_id long, label int")
    found = drawn_examples(documents(spark, rows), known, 100, "x").collect()
    got = sorted((r.doc_id, r.text, r.label) for r in found)
    assert got == [(0, "same", 0), (1, "same", 0), (1, "same", 1), (2, "same", 0), (7, "other", 1)]


def test_quality_reads_the_whole_text(spark):
    docs, labels = labelled(
        spark, lambda i: words(40, i), lambda i: re.sub(" ", "%%% ", words(40, i)), "quality"
    )
    scored = quality.quality(docs, labels)
    truth = scored.join(labels, "doc_id").where("held_out").collect()
    assert truth and np.mean([r.predicted == r.quality for r in truth]) > 0.95
    assert scored.count() == docs.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    kept = quality.without_poor(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_parts_of_long_documents_have_the_chunks_of_the_whole(monkeypatch):
    net = quality.ByteNetwork.fresh()
    part = quality.BLOCK * quality.STRIDE * 16
    tail = quality.BLOCK * (quality.CHUNK - quality.STRIDE + 1)
    monkeypatch.setattr(quality, "PART_BYTES", part)
    monkeypatch.setattr(quality, "STEP_BYTES", 1000)
    pooled, seen = quality.pooled_chunks, []
    monkeypatch.setattr(quality, "pooled_chunks", lambda *a: seen.append(pooled(*a)) or seen[-1])
    random_numbers = np.random.default_rng(4)
    for size in (part + 1, part + tail, part + tail + 1, 2 * part, 3 * part + 4, 3 * part + tail + 777):
        data = random_numbers.integers(1, 256, size, dtype=np.uint8)
        offsets = np.array([0, size])
        whole, owner = pooled(net, *quality.blocks_of(data, offsets))
        total, largest = whole.sum(axis=0)[None], whole.max(axis=0)[None]
        expected = quality.combine(net, total, largest, np.array([len(owner)]))
        seen.clear()
        got = quality.probabilities(net, data, offsets)
        assert sum(len(best) for best, _ in seen) == len(whole)
        assert len(seen) > 1 or size <= part + tail
        np.testing.assert_allclose(np.concatenate([best for best, _ in seen]), whole, atol=1e-5)
        np.testing.assert_allclose(got, expected, atol=1e-6)


def test_long_documents_score_alike_in_parts(monkeypatch):
    net = quality.ByteNetwork.fresh()
    raw = np.frombuffer(words(20_000, 8).encode(), np.uint8)
    offsets = np.array([0, len(raw)])
    whole = quality.combine(
        net,
        *(lambda best: (best.sum(axis=0)[None], best.max(axis=0)[None], np.array([len(best)])))(
            quality.pooled_chunks(net, *quality.blocks_of(raw, offsets))[0]
        ),
    )
    monkeypatch.setattr(quality, "PART_BYTES", quality.BLOCK * quality.STRIDE * 16)
    assert quality.probabilities(net, raw, offsets) == pytest.approx(whole, abs=0.02)


def test_languages_are_told_apart(spark):
    letters = {"en": "thewandofing", "de": "derschungkeit", "fr": "leauxétionque"}
    draw = random.Random(6)
    rows = []
    for i in range(240):
        lang = list(letters)[i % 3]
        text = " ".join("".join(draw.choices(letters[lang], k=6)) for _ in range(15))
        rows.append((i, text, lang, "a"))
    rows += [(1000, None, "en", "a"), (1001, "123 !?", "en", "a"), (1002, "", None, "a"), (None, "the wand", "en", "a")]
    docs = documents(spark, rows)
    found = language.languages(docs)
    truth = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out and doc_id < 1000").collect()
    assert truth and np.mean([r.lang == r.lang_pred for r in truth]) > 0.95
    odd = {r.doc_id: r.lang_pred for r in found.where("doc_id >= 1000").collect()}
    assert odd == {1000: "und", 1001: "und", 1002: "und"}
    assert found.count() == len(rows)
    assert language.languages(docs.limit(0)).count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "mix"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
    mixed = corpus_pipeline.run(spark, sf_dir)
    assert mixed.select("doc_id").distinct().count() == mixed.count()
    toxic = mixed.join(labels.where("toxic = 1"), "doc_id").count()
    assert toxic <= labels.where("toxic = 1").count() // 2
    assert mixed.where(F.col("taken") > 3 * F.col("size")).count() == 0
