"""Alignment of two tokenizers against every pair of token occurrences."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import token_align

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, block string, pairs int, n_a string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def gpt_bytes():
    """Byte of every character of a byte-level vocabulary, spelled out from its three printable runs."""
    table, spare = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            table[chr(byte)] = byte
        else:
            table[chr(spare)] = byte
            spare += 1
    return table


@pytest.fixture(scope="module")
def models():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def plain(models, rows):
    a_model, b_model = models
    table = gpt_bytes()
    encoded, counts = [], Counter()
    for doc_id, text in rows:
        a = a_model.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(table[c] for c in a_model.id_to_token(t)) for t in a]
        b_bytes = [
            bytes([int(b_model.id_to_piece(t)[3:5], 16)]) if b_model.is_byte(t)
            else b_model.id_to_piece(t).replace("▁", " ").encode()
            for t in b
        ]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            encoded.append((doc_id, None))
            continue
        ends = []
        for tokens in (a_bytes, b_bytes):
            at, found = 0, []
            for token in tokens:
                at += len(token)
                found.append(at)
            ends.append(found)
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups = {end: ([], []) for end in shared}
        for side, (ids, places) in enumerate(((a, ends[0]), (b, ends[1]))):
            for token, end in zip(ids, places):
                groups[min(s for s in shared if s >= end) if len(shared) < 50 else _next(shared, end)][side].append(token)
        groups = [groups[s] for s in shared]
        links = [(x, y) for left, right in groups for x in left for y in right]
        counts.update(set(links))
        encoded.append((doc_id, (a, b, groups, links)))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    result = []
    for doc_id, found in encoded:
        if found is None:
            result.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = found
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        result.append(
            (
                doc_id, len(a), len(b), len(groups), len(links),
                sum(counts[link] == best[link[0]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(result, key=repr)


def _next(shared, end):
    import bisect

    return shared[bisect.bisect_left(shared, end)]


def odd_texts():
    draw = random.Random(11)
    made = ["".join(draw.choices("abc dé世🙂\n \t<|▁'s ", k=draw.randint(1, 80))) for _ in range(150)]
    return [
        None, "", " ", "\n", "▁", " ▁ x", "<|endoftext|> and <s> </s> <unk>", "a\x00b\x7f", "全한🙂ﬁ",
        "nospace" * 200, "  two  blanks  ", "the same words here", "the same words here", "x" * 3000,
        " hard  blanks 　wide", "word é " * 4000, "1234567890" * 50, "\r\n\t", "don't we'll",
        *made, made[0],
    ]


def rows_of(spark, texts):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame([(*r, "en", "b", 3, "x") for r in rows], DOCS).repartition(3)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 500, "kept_tokens": 40}])
def test_alignment_equals_all_occurrences(spark, models, options, monkeypatch):
    if options:
        monkeypatch.setattr(token_align, "SMALL_GROUP", 1)
        monkeypatch.setattr(token_align, "GROUP_BYTES", 300)
    rows, docs = rows_of(spark, odd_texts())
    found = token_align.alignment(docs, **options)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == plain(models, rows)


@pytest.fixture(scope="module")
def sides():
    import public_tokenizers

    a = token_align.ByteLevel(public_tokenizers.path("byte_bpe_50k.json"))
    return a, token_align.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_ranks_and_merges_give_the_same_ids(models, sides):
    a, b = sides
    assert a.ranked is not None
    texts = [t or "" for t in odd_texts()] + ["a  b   c\n\n d! e's    f " * 40, "\n" * 10_000 + "x", "x" * 50_000]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}\t{chr(c)}'{chr(c)}!" for c in [*range(1, 0x3000), *range(0x1F300, 0x1FA00, 7)]]
    expected = [e.ids for e in models[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    for some in (texts[:1], texts):
        assert [ids.tolist() for ids in a.encode(some)] == expected[: len(some)]
    alone = [a.encode([t])[0].tolist() for t in texts[:300]]
    assert alone == expected[:300]


def test_other_merges_are_no_ranks(tmp_path):
    import json

    import public_tokenizers

    spec = json.load(open(public_tokenizers.path("byte_bpe_50k.json")))
    merges = spec["model"]["merges"]
    merges[100], merges[200] = merges[200], merges[100]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    assert token_align.ByteLevel(str(path)).ranked is None


def test_long_groups_count_repeated_ids(sides):
    a, b = sides
    # Ids spelled by hand: groups of 8 a tokens and 1 b token, and one of many a and 1 b token of the same bytes.
    one, wide = a.spelled.index(b"="), next(i for i, s in enumerate(b.spelled) if s == b"=" * 8)
    space = a.spelled.index(b" "), b.spelled.index(b" ")
    raw = b" " + b"=" * 80
    import numpy as np

    of_a = [np.array([space[0]] + [one] * n, np.int32) for n in (80, 79)]
    of_b = [np.array([space[1]] + [wide] * 10, np.int32)] * 2
    for small in (64, 4):
        token_align.SMALL_GROUP, kept = small, token_align.SMALL_GROUP
        try:
            right, wrong = token_align.Aligner(a, b).aligned([raw, raw], of_a, of_b)
        finally:
            token_align.SMALL_GROUP = kept
        n_a, n_b, text, groups, links, pairs, times = right
        assert (n_a, n_b, groups, links, sorted(times.tolist())) == (81, 11, 11, 81, [1, 80])
        assert text == f"{space[0]}|{space[1]};" + ";".join([",".join([str(one)] * 8) + f"|{wide}"] * 10)
        assert wrong is None


def test_empty_table_and_only_empty_texts(spark):
    _, docs = rows_of(spark, [None, "", None])
    assert token_align.alignment(docs.limit(0)).collect() == []
    assert {tuple(r)[1:] for r in token_align.alignment(docs).collect()} == {(0, 0, 0, 0, 0, 0, "")}


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_query_equals_all_occurrences(spark, models):
    from kindred.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = QUERIES["op12_token_alignment"](spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(models, rows)


def test_block_entries_are_packed_as_narrow_as_they_can_be(spark):
    """The lists with an entry per pair of a document are bytes, not arrays of long numbers."""
    for values in ([], [0], [255], [256, 1], [65_536, 3], [2**32, 0], [2**40, 7]):
        numbers = np.array(values, np.int64)
        raw = pa.scalar(token_align._narrow(numbers), pa.binary())
        assert token_align._wide(raw, len(values)).tolist() == values
    rows = [(1, "one two three one two"), (2, None), (3, "three four"), (4, "")]
    blocks = token_align.aligned_blocks(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    for row in blocks.collect():
        assert len(row.local) == len(row.times) == sum(row.n_pairs) > 0
    empty = spark.createDataFrame([(5, ""), (6, None)], "doc_id long, text string").coalesce(1)
    assert [(r.n_links, r.n_best) for r in token_align.alignment(empty).collect()] == [(0, 0)] * 2
