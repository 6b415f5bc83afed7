"""Archives of large payloads in several files; mixes written out; components of many sets."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest

from kindred.llm import mixing, warc
from kindred.storage import fresh_path

PAGES = "page_id long, url string, html string"


def test_files_are_bounded_by_bytes(spark):
    rows = [(i, f"http://h/{i}", "s" * (i % 7)) for i in range(60)]
    rows += [(100 + i, "http://m", chr(97 + i % 20) * 5000) for i in range(40)]
    rows += [(200 + i, "http://l", str(i % 3) * 3_000_000) for i in range(6)]
    pages = spark.createDataFrame(rows, PAGES).repartition(2)
    folder = fresh_path(spark, "bounded")
    warc.write_archives(pages, folder, file_bytes=64_000, size_step=1000)
    files = [p for p in Path(folder.removeprefix("file:")).rglob("part-*")]
    assert len({p.parent.name for p in files}) == 3 and len(files) > 10
    import gzip

    for file in files:
        kept = [len(block) for _, block in warc.parse_records(gzip.open(file))]
        # Files of small pages hold many records, those of pages beyond the bound one each.
        assert kept and (sum(kept) <= 64_000 + 200 * len(kept) or len(kept) == 1)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in warc.read_archives(spark, folder).collect()}
    firsts = {}
    for page_id, _, html in rows:
        firsts.setdefault(html, page_id)
    assert got == {
        i: (
            len(t), hashlib.sha256(t.encode()).hexdigest(),
            *(("revisit", firsts[t]) if len(t) >= 100 and firsts[t] != i else ("response", None)),
        )
        for i, _, t in rows
    }


def test_documents_of_a_mix_are_repeated(spark):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2]) for i in range(40)] + [(None, "w w", "a"), (99, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs)
    times = {r.doc_id: r.repetitions for r in mixed.collect()}
    found = mixing.repeated(docs, mixed)
    assert found.columns == [*docs.columns, "repetition"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r.repetition)
    assert {i: sorted(v) for i, v in got.items()} == {
        i: list(range(1, n + 1)) for i, n in times.items() if n
    }
    assert sum(times.values()) > len(rows) / 2
    assert mixing.repeated(docs, mixed.limit(0)).count() == 0


def test_pipeline_handles_odd_tables(spark, tmp_path):
    import corpus_pipeline

    text = " ".join(f"word{i} and more" for i in range(30))
    rows = [(1, text, "en", "a", 3), (2, text, "en", "a", 3), (2, text, "en", "a", 3), (3, None, None, None, 0),
            (4, "", "de", "b", 0), (None, "some words here", "en", "b", 1)]
    shape = "doc_id long, text string, lang string, source string, score int"
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    for name, some in (("full", rows), ("empty", [])):
        folder = tmp_path / name
        spark.createDataFrame(some, shape).write.parquet(str(folder / "documents.parquet"))
        labels.limit(1 if some else 0).write.parquet(str(folder / "labels.parquet"))
        benchmark.write.parquet(str(folder / "benchmark.parquet"))
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert all(r.taken <= 3 * r.size for r in found)
        # One of the equal texts stays.
        assert sum(r.doc_id in (1, 2) for r in found) == (1 if some else 0)


@pytest.mark.parametrize("heavy", [True, False])
def test_component_of_most_sets_gets_its_id(spark, heavy):
    from kindred.llm import jaccard_join

    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        if heavy or i % 2:
            words[i % 80] = f"changed{i}"
        else:
            words = [f"{w}of{i}" for w in base]
        rows.append((1000 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
    one = [1000 - i for i in range(60) if heavy or i % 2]
    assert found == {i: min(one) if i in one else i for i in found} and len(found) == 60
