"""Token counts of long texts, whatever they begin with."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest

from kindred.llm import token_counts

SF_DIR = "/root/testdata/sf0.01"
BEGINNINGS = ["全", "한", "🙂", "ﬁ", "\n", "\n\n", "  ", " ", "\t", "▁", "a", "é", "<s>", "1"]
TAILS = [" plain words follow here", "全한🙂ﬁ", "\n\nline after line", "한국어 문장 ", "  two  blanks"]


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize(
    "chunk,overlap,size",
    [(64, 16, 600), (200, 16, 1500), (4096, 256, 13_000),
     (token_counts.CHUNK_BYTES, token_counts.OVERLAP_BYTES, 140_000)],
)
def test_any_beginning_counts_as_the_whole_text(path, chunk, overlap, size):
    counter = token_counts.ChunkedCounter(path, chunk, overlap)
    for beginning in BEGINNINGS:
        for tail in TAILS:
            text = beginning + tail * (size // len(tail.encode()) + 1)
            assert counter.count(text) == len(counter.model.encode(text)), (beginning, tail)
        alone = beginning * (size // len(beginning.encode()) + 1)
        assert counter.count(alone) == len(counter.model.encode(alone)), beginning


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")
def test_all_documents_in_small_chunks(path):
    counter = token_counts.ChunkedCounter(path, 256, 32)
    for text in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"])["text"].to_pylist():
        assert counter.count(text or "") == len(counter.model.encode(text or ""))


def test_empty_table_and_one_long_row(spark, path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(empty, path).collect() == []
    text = "한국어 " * 12_000
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = token_counts.token_counts(rows, path).collect()
    whole = token_counts.ChunkedCounter(path).model.encode(text)
    assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), len(whole), True)
