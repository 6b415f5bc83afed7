from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from kindred.operators import baskets, itemsets, rules, sampling


def random_baskets(n: int, seed: int = 1) -> dict[int, list[str]]:
    rng = random.Random(seed)
    items = [str(code) for code in range(7, 19)]
    return {i: rng.sample(items, rng.randint(1, 6)) for i in range(n)}


def as_rows(spark, content: dict[int, list[str]]):
    return spark.createDataFrame(
        [(b, i) for b, items in content.items() for i in items], "basket long, item string"
    )


def brute_force(content, thresholds, max_k=3):
    """Counts of all itemsets above their threshold with frequent subsets."""
    n = len(content)
    found: dict[tuple, int] = {}
    for k in range(1, max_k + 1):
        counts = Counter(c for items in content.values() for c in combinations(sorted(items), k))
        bound = thresholds[k] if isinstance(thresholds[k], int) else thresholds[k] * n
        for itemset, cnt in counts.items():
            subsets = combinations(itemset, k - 1) if k > 1 else []
            if cnt > bound and all(s in found for s in subsets):
                found[itemset] = cnt
    return found


def collected(df):
    return {tuple(r["items"]): r["cnt"] for r in df.collect()}


@pytest.mark.parametrize(
    "thresholds", [{1: 20, 2: 5, 3: 2}, {1: 0.3, 2: 0.1, 3: 0.03}, {1: 10, 2: 8, 3: 1}]
)
def test_itemsets_equal_brute_force(spark, thresholds):
    content = random_baskets(80)
    found = itemsets.frequent_itemsets(as_rows(spark, content), thresholds)
    assert collected(found) == brute_force(content, thresholds)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_equally_wide_baskets_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(itemsets._extend, "__defaults__", (block,))
    content = random_baskets(30, seed=3)
    for extra in range(5):
        content[900 + extra] = [str(code) for code in range(7 + extra, 21 + extra)]
    thresholds = {1: 2, 2: 2, 3: 2}
    found = itemsets.frequent_itemsets(as_rows(spark, content), thresholds)
    assert collected(found) == brute_force(content, thresholds)


def test_four_levels(spark):
    content = random_baskets(60, seed=5)
    thresholds = {1: 3, 2: 3, 3: 2, 4: 1}
    found = itemsets.frequent_itemsets(as_rows(spark, content), thresholds, max_k=4)
    assert collected(found) == brute_force(content, thresholds, 4)


def test_threshold_is_strict_and_order_is_of_strings(spark):
    content = {1: ["72892002", "444814009"], 2: ["72892002", "444814009"], 3: ["9"]}
    found = collected(itemsets.frequent_itemsets(as_rows(spark, content), {1: 1, 2: 1}, 2))
    assert found == {("444814009",): 2, ("72892002",): 2, ("444814009", "72892002"): 2}
    assert not collected(itemsets.frequent_itemsets(as_rows(spark, content), {1: 2, 2: 2}, 2))


def test_empty_input(spark):
    assert not collected(itemsets.frequent_itemsets(as_rows(spark, {}), {1: 0, 2: 0, 3: 0}))


def test_fpgrowth_finds_the_same_sets(spark):
    content = random_baskets(100, seed=9)
    rows = as_rows(spark, content)
    ours = collected(itemsets.frequent_itemsets(rows, {1: 4, 2: 4, 3: 4}))
    arrays = baskets.basket_arrays(rows)
    model = FPGrowth(itemsCol="items", minSupport=4.5 / 100).fit(arrays)
    theirs = {
        tuple(sorted(r["items"])): r["freq"]
        for r in model.freqItemsets.collect()
        if len(r["items"]) <= 3
    }
    assert ours == theirs


def test_top_itemsets_break_ties_by_items(spark):
    content = {1: ["b", "a"], 2: ["a", "b"], 3: ["c"]}
    found = itemsets.frequent_itemsets(as_rows(spark, content), {1: 0}, 1)
    assert [r["items"] for r in itemsets.top_itemsets(found, 1, 2).collect()] == [["a"], ["b"]]


def test_repeated_rows_and_nulls_count_once(spark):
    rows = spark.createDataFrame(
        [("p", "x"), ("p", "x"), ("p", None), (None, "x")], "PATIENT string, CODE string"
    )
    assert baskets.basket_rows(rows, "PATIENT", "CODE").collect() == [("p", "x")]


# Published counts: single conditions, one pair or triple each, and the sum of all
# frequent single counts over 156,450 baskets.
GOLDEN_COUNTS = [
    (1, ["444814009"], 24456),
    (1, ["195662009"], 14165),
    (1, ["15777000"], 7155),
    (1, ["271737000"], 7082),
    (1, ["40055000"], 5068),
    (2, ["195662009", "444814009"], 320),
    (2, ["271737000", "444814009"], 160),
    (2, ["195662009", "271737000"], 85),
    (2, ["195662009", "40055000"], 57),
    (2, ["40055000", "444814009"], 115),
    (2, ["15777000", "271737000"], 131),
    (2, ["15777000", "444814009"], 163),
    (3, ["195662009", "271737000", "444814009"], 5),
    (3, ["195662009", "40055000", "444814009"], 3),
    (3, ["15777000", "271737000", "444814009"], 4),
]
FREQUENT_TOTAL = 133_763
N_BASKETS = 156_450


def test_published_rule_values(spark):
    rest = FREQUENT_TOTAL - sum(cnt for k, _, cnt in GOLDEN_COUNTS if k == 1)
    counts = [*GOLDEN_COUNTS, (1, ["others"], rest)]
    table = spark.createDataFrame(counts, "k int, items array<string>, cnt bigint")
    scored = {
        (tuple(r["antecedent"]), r["consequent"]): r
        for r in rules.association_rules(table, N_BASKETS, 3, "literal").collect()
    }
    published = {
        (("195662009", "40055000"), "444814009"): ("0.0526", "-0.1302", "1.0017"),
        (("195662009", "271737000"), "444814009"): ("0.0588", "-0.1240", "1.0028"),
        (("271737000", "444814009"), "15777000"): ("0.0250", "-0.0285", "1.0222"),
        (("195662009", "444814009"), "40055000"): ("0.0094", "-0.0285", "1.0630"),
    }
    for rule, values in published.items():
        row = scored[rule]
        got = tuple(f"{row[c]:.4f}" for c in ("confidence", "interest", "std_lift"))
        assert got == values


def small_itemsets(spark):
    content = random_baskets(80)
    found = itemsets.frequent_itemsets(as_rows(spark, content), {1: 20, 2: 5, 3: 2})
    return content, found


def test_textbook_rules(spark):
    content, found = small_itemsets(spark)
    n = len(content)

    def share(*items):
        return sum(set(items) <= set(basket) for basket in content.values()) / n

    rows = rules.association_rules(found, n, 3).collect()
    assert rows
    for row in rows:
        px, py = share(*row["antecedent"]), share(row["consequent"])
        both = share(*row["antecedent"], row["consequent"])
        low = max(px + py - 1, 1 / n) / (px * py)
        width = 1 / max(px, py) - low
        assert row["confidence"] == pytest.approx(both / px)
        assert row["interest"] == pytest.approx(both / px - py)
        assert row["lift"] == pytest.approx(both / px / py)
        assert row["std_lift"] == pytest.approx((row["lift"] - low) / (width or 1))


def test_literal_pair_rules_look_up_the_second_character(spark):
    counts = [(1, ["12"], 8), (1, ["2"], 4), (1, ["75"], 5), (2, ["12", "75"], 3)]
    table = spark.createDataFrame(counts, "k int, items array<string>, cnt bigint")
    lifts = {
        r["consequent"]: (r["confidence"], r["lift"])
        for r in rules.association_rules(table, 10, 2, "literal").collect()
    }
    assert lifts["75"] == (3 / 8, 3 / 8 / 4)  # second character of "12" is the item "2"
    assert lifts["12"] == (3 / 5, 3 / 5)  # no item "5"


def test_strong_rules_are_sorted_and_inclusive(spark):
    table = spark.createDataFrame(
        [(["a"], "b", 0.2), (["c"], "d", 0.9), (["e"], "f", 0.19)],
        "antecedent array<string>, consequent string, std_lift double",
    )
    assert [r["std_lift"] for r in rules.strong_rules(table).collect()] == [0.9, 0.2]


def test_hash_sample_keeps_whole_baskets(spark):
    rows = as_rows(spark, random_baskets(300))
    taken = sampling.hash_percent_sample(rows, "basket", 30)
    sizes = {r["basket"]: r["n_items"] for r in baskets.basket_sizes(rows).collect()}
    got = {r["basket"]: r["n_items"] for r in baskets.basket_sizes(taken).collect()}
    assert 40 < len(got) < 140
    assert all(sizes[b] == n for b, n in got.items())


def test_numbering_is_dense(spark):
    ids = spark.range(0, 1000, 3).withColumnRenamed("id", "doc_id")
    numbers = sorted(r["idx"] for r in sampling.numbered(ids).collect())
    assert numbers == list(range(334))


def test_random_pairs_are_distinct_and_ordered(spark):
    ids = spark.range(50).withColumnRenamed("id", "doc_id")
    pairs = [tuple(r) for r in sampling.random_pairs(ids, draws_per_row=20).collect()]
    assert len(pairs) == len(set(pairs)) > 400
    assert all(x < y for x, y in pairs)


def test_samples_are_of_the_asked_size(spark):
    ids = spark.range(500).withColumnRenamed("id", "doc_id")
    sizes = sampling.seeded_samples(ids, 20, 3).groupBy("seed").agg(F.count("*").alias("n"))
    assert [r["n"] for r in sizes.collect()] == [20, 20, 20]


@pytest.mark.parametrize("block", [2, 256])
def test_shared_and_wide_baskets_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(itemsets._extend, "__defaults__", (block,))
    rng = random.Random(block)
    items = [f"i{k:02d}" for k in range(40)]
    content = {b: rng.sample(items, rng.randint(20, 35)) for b in range(12)}
    # A third of all baskets are one and the same.
    content.update({100 + b: ["i03", "i01", "i02"] for b in range(20)})
    content.update({200 + b: rng.sample(items, 3) for b in range(30)})
    thresholds = {1: 8, 2: 7, 3: 6, 4: 5}
    found = itemsets.frequent_itemsets(as_rows(spark, content), thresholds, max_k=4)
    assert collected(found) == brute_force(content, thresholds, 4)
    ranges = itemsets._extend(as_rows(spark, content)).collect()
    assert max(r.n for r in ranges) >= 20
    assert sum(r.n for r in ranges if r.low == 0) == len(content)
    assert all(r.high - r.low < block for r in ranges)
