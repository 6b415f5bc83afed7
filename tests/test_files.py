from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from kindred.sources import readers, writers


def test_basket_lines_round_trip(spark, tmp_path):
    baskets = spark.createDataFrame(
        [(1, ["127013003", "271737000"]), (2, ["444814009"])], "basket_id long, items array<string>"
    )
    path = str(tmp_path / "baskets")
    writers.write_basket_lines(baskets, path)
    lines = {r["value"] for r in spark.read.text(path).collect()}
    assert lines == {"127013003, 271737000", "444814009"}
    back = readers.read_basket_lines(spark, path).collect()
    assert sorted(r["items"] for r in back) == [["127013003", "271737000"], ["444814009"]]
    with pytest.raises(AnalysisException):
        writers.write_basket_lines(baskets, path)


def test_conditions_are_strings_found_by_name(spark, tmp_path):
    file = tmp_path / "conditions.csv"
    file.write_text("START,PATIENT,CODE\n2020-01-01,p1,007\n2020-01-02,p2,10509002\n")
    rows = readers.read_conditions(spark, str(file)).collect()
    assert [tuple(r) for r in rows] == [("p1", "007"), ("p2", "10509002")]


def test_json_documents(spark, tmp_path):
    file = tmp_path / "articles.json"
    file.write_text('{"tweet_id": "9", "text": "a\\nb", "other": 1}\n{"tweet_id": "8", "text": "c"}\n')
    rows = readers.read_json_documents(spark, str(file)).collect()
    assert [tuple(r) for r in rows] == [("9", "a\nb"), ("8", "c")]


def test_sentences(spark, tmp_path):
    file = tmp_path / "pairs.txt"
    file.write_text("pair_ID\tsentence_A\tsentence_B\n1\tA dog runs\tA cat\n")
    assert [tuple(r) for r in readers.read_sentences(spark, str(file)).collect()] == [("A dog runs",)]


def read_ordered(spark, path):
    """Lines of the part files in the order of their names."""
    import glob

    lines = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part, encoding="utf-8") as handle:
            lines += handle.read().splitlines()
    return lines


def test_itemset_report(spark, tmp_path):
    top = spark.createDataFrame(
        [(2, ["10509002", "444814009"], 237), (2, ["195662009", "444814009"], 320)],
        "k int, items array<string>, cnt bigint",
    )
    path = str(tmp_path / "report")
    writers.write_lines(writers.itemset_report(top, 2), path)
    assert read_ordered(spark, path) == [
        "Top 10 frequent itemsets for k=2:",
        "('195662009', '444814009'): 320",
        "('10509002', '444814009'): 237",
    ]


def test_rule_report(spark, tmp_path):
    table = spark.createDataFrame(
        [
            (["1", "2"], "3", 0.25, 0.03125, 0.15625, -0.12999),
            (["7"], "8", 1234.5, 0.5, 1.0, -0.00001),
        ],
        "antecedent array<string>, consequent string, std_lift double, lift double,"
        " confidence double, interest double",
    )
    path = str(tmp_path / "rules")
    writers.write_lines(writers.rule_report(table, 3), path)
    numbers = [
        f"7 -> 8\t{1234.5:.4f}\t{0.5:.4f}\t{1.0:.4f}\t{-0.00001:.4f}",
        f"('1', '2') -> 3\t{0.25:.4f}\t{0.03125:.4f}\t{0.15625:.4f}\t{-0.12999:.4f}",
    ]
    assert read_ordered(spark, path) == [
        "Association Rules",
        "=" * 41,
        "Association Rule\t                   Std Lift\tLift  Confidence Interest",
        "=" * 41,
        *numbers,
    ]


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("PATIENT,CODE\np1,c1\n")
    (tmp_path / "b.csv").write_text("CODE,PATIENT\nc2,p2\n")
    with pytest.raises(Exception):
        readers.read_conditions(spark, str(tmp_path)).collect()


def test_broken_json_lines_are_refused(spark, tmp_path):
    file = tmp_path / "broken.json"
    file.write_text('{"tweet_id": "1", "text": "a"}\n{"tweet_id": "2", "te\n')
    with pytest.raises(Exception):
        readers.read_json_documents(spark, str(file)).collect()
