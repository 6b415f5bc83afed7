"""Files with broken lines and lines in order; samples and totals from one pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kindred.operators import documents, sampling
from kindred.sources import readers, writers
from kindred.storage import staged_observed


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_last_line_wins_over_several_splits(spark, small_splits, tmp_path):
    lines = {}
    for file in ("b.json", "a.json", "c.json"):
        lines[file] = [f'{{"tweet_id":"{(i * 7) % 20}","text":"{file} {i}"}}' for i in range(100)]
        (tmp_path / file).write_text("\n".join(lines[file]) + "\n")
    found = readers.read_json_lines(spark, str(tmp_path))
    assert found.rows.select("position.file", "position.block").distinct().count() > 20
    latest = documents.latest_per_id(found.rows, "doc_id", "text", "position").collect()
    expected = {str((i * 7) % 20): f"c.json {i}" for i in range(100)}
    assert {r.doc_id: r.text for r in latest} == expected
    order = [r.text for r in found.rows.orderBy("position").collect()]
    assert order == [f"{file} {i}" for file in sorted(lines) for i in range(100)]
    assert found.refused.count() == 0


def test_broken_json_lines_are_set_aside(spark, tmp_path):
    good = ['{"tweet_id": 1, "text": "a"}', ' {"text": null, "tweet_id": 2, "more": [1]}', '{"tweet_id": 3}']
    bad = {
        '{"tweet_id": 4, "text": "cut': "not readable",
        '{"tweet_id": "x", "text": "a"}': "not readable",
        '{"text": "no id"}': "no id",
        '{"tweet_id": null, "text": "a"}': "no id",
        "[1, 2]": "no object",
        "plain words": "no object",
        "7": "no object",
    }
    (tmp_path / "x.json").write_text("\r\n".join([*good, "", "  ", *bad]))
    found = readers.read_json_lines(spark, str(tmp_path), "bigint")
    assert sorted((r.doc_id, r.text) for r in found.rows.collect() if r.text) == [(1, "a")]
    assert {r.doc_id for r in found.rows.collect()} == {1, 2, 3}
    refused = found.refused.collect()
    assert {r.line: r.reason for r in refused} == bad
    assert all(r.file.endswith("x.json") for r in refused)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.read_json_documents(spark, str(tmp_path), "bigint").collect()


def test_lines_unlike_the_header_are_set_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,PATIENT,CODE\n1,p,"x, y"\n2,q\n3,r,z,more\n4,s,\n')
    found = readers.read_checked_columns(spark, str(tmp_path), ["PATIENT", "CODE"])
    assert sorted(map(tuple, found.rows.collect())) == [("p", "x, y"), ("s", None)]
    assert {(r.line, r.reason) for r in found.refused.collect()} == {
        ("2,q", "not as the header"), ("3,r,z,more", "not as the header"),
    }


def test_empty_files_give_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    found = readers.read_json_lines(spark, str(tmp_path))
    assert found.rows.count() == found.refused.count() == 0


def test_quoted_texts_come_back_whole(spark, tmp_path):
    texts = ["a\tb", "two\nlines", "\r\nstart", 'say "x"', " blank ", "\\ back", "é 世", "tab\t\"q\"\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "pair_ID long, sentence_A string")
    writers.write_quoted(rows, str(tmp_path / "t"), sep="\t")
    found = readers.read_sentences(spark, str(tmp_path / "t"), multiline=True)
    assert sorted(r.sentence_A for r in found.collect()) == sorted(texts)


def test_samples_of_all_seeds_are_those_of_each(spark):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    drawn = sampling.seeded_samples(ids, 50, 4)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 3000") == 1 and "WindowGroupLimit" in plan
    got = {}
    for r in drawn.collect():
        got.setdefault(r.seed, set()).add(r.doc_id)
    assert got == {
        s: {r.doc_id for r in sampling.random_rows(ids, 50, seed=s).collect()} for s in range(4)
    }
    assert {r["n"] for r in sampling.seeded_samples(ids.limit(7), 50, 2).groupBy("seed").agg(F.count("*").alias("n")).collect()} == {7}


def test_totals_are_those_of_the_stored_rows(spark):
    rows = spark.range(1000).repartition(7)
    stored, seen = staged_observed(rows, "observed", n=F.count(F.lit(1)), high=F.max("id"))
    assert (stored.count(), seen["n"], seen["high"]) == (1000, 1000, 999)
    _, none = staged_observed(rows.where("id < 0"), "observed", high=F.max("id"))
    assert none["high"] is None
