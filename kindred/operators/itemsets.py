"""Frequent itemsets by the A-Priori principle, on long-form baskets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.baskets import count_baskets
from kindred.operators.skew import join_counted
from kindred.storage import staged

# Strict lower bounds on counts per itemset size.
COUNT_THRESHOLDS = {1: 1000, 2: 2, 3: 2}

# Items of one basket that itemsets are begun with in one task.
ITEM_BLOCK = 256


def support_bound(threshold: int | float, n_baskets: int) -> float:
    """An int is a count, a float a fraction of the baskets."""
    return threshold if isinstance(threshold, int) else threshold * n_baskets


def count_items(rows: DataFrame) -> DataFrame:
    """``(item, cnt)``; partial counts are made before the shuffle."""
    return rows.groupBy("item").agg(F.count("*").alias("cnt"))


def _columns(k: int) -> list[str]:
    return [f"i{position}" for position in range(1, k + 1)]


def _as_itemsets(counted: DataFrame, k: int) -> DataFrame:
    return counted.select(
        F.lit(k).alias("k"), F.array(*_columns(k)).alias("items"), "cnt"
    )


def _extend(kept: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """``(items, low, high, n)``: distinct baskets to extend itemsets in, by ranges of leading items.

    ``n`` baskets hold exactly these sorted items, at least two; ``low`` to ``high`` are the places of at most
    ``block`` items that itemsets begin with there. A basket that very many share is one row, and a wide one is
    dealt to many tasks, a range each. Lists hold frequent items only, which bounds them by their number.
    """
    last = F.size("items") - 2
    ranges = (
        kept.groupBy("basket")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .where(F.size("items") > 1)
        .select("items", F.explode(F.sequence(F.lit(0), last, F.lit(block))).alias("low"))
    )
    return (
        ranges.groupBy("items", "low")
        .agg(F.count("*").alias("n"))
        .select("items", "low", F.least(F.col("low") + block - 1, last).alias("high"), "n")
    )


def _led(ranges: DataFrame) -> DataFrame:
    """``(i1, tail, n)``: each item that itemsets begin with, and the later items of its basket."""
    heads = ranges.select("items", "n", F.explode(F.sequence("low", "high")).alias("at"))
    return heads.select(
        F.get("items", F.col("at")).alias("i1"), _after(F.col("items"), F.col("at")).alias("tail"), "n"
    )


def _after(items: Column, at: Column) -> Column:
    """The items behind a place counted from 0."""
    return F.slice(items, at + 2, F.greatest(F.size(items) - at - 1, F.lit(0)))


def _longer(led: DataFrame, smaller: DataFrame, k: int) -> DataFrame:
    """Rows led by itemsets of size k-1 from those led by the size before, for frequent ones only.

    ``led`` has leading items and the ``tail`` of their basket, ``smaller`` the frequent itemsets of size k-1. Of a tail,
    items that no frequent itemset adds to the leading ones are left out, before it is cut up any further.
    """
    *leading, last = _columns(k - 1)
    partners = smaller.groupBy(*leading).agg(
        F.collect_list(last).alias("_partners"), F.sum("cnt").alias("_held")
    )
    kept = join_counted(led, partners, leading, "_held").select(
        *leading, F.array_intersect("tail", "_partners").alias("tail"), "n"
    )
    cut = kept.where(F.size("tail") > 1).select(
        *leading, "tail", "n", F.posexplode("tail").alias("_at", last)
    )
    return cut.select(*leading, last, _after(F.col("tail"), F.col("_at")).alias("tail"), "n")


def has_frequent_subsets(candidates: DataFrame, smaller: DataFrame, k: int) -> DataFrame:
    """Keep candidates all of whose (k-1)-subsets are frequent.

    Smaller subsets need no test: a frequent (k-1)-itemset has frequent subsets only.
    """
    for left_out in _columns(k):
        subset = [column for column in _columns(k) if column != left_out]
        frequent = smaller.select(
            *[F.col(old).alias(new) for old, new in zip(_columns(k - 1), subset, strict=True)]
        )
        candidates = candidates.join(frequent, subset, "left_semi")
    return candidates


def frequent_itemsets(
    rows: DataFrame,
    thresholds: Mapping[int, int | float] = COUNT_THRESHOLDS,
    max_k: int = 3,
    n_baskets: int | None = None,
) -> DataFrame:
    """``(k, items, cnt)`` of all itemsets of up to ``max_k`` items above their threshold.

    ``rows`` are distinct ``(basket, item)`` rows, read several times and best a
    stored table; ``items`` are sorted as strings. ``n_baskets`` saves a pass over the
    rows where it is known.

    Baskets are put together from their frequent items once. Each further level is counted from them
    with one shuffle, that of the counts, which are summed up in each task before.
    """
    n_baskets = count_baskets(rows) if n_baskets is None else n_baskets
    bounds = {k: support_bound(thresholds[k], n_baskets) for k in range(1, max_k + 1)}
    singles = staged(count_items(rows).where(F.col("cnt") > bounds[1]), "frequent-items")
    smaller = singles.withColumnRenamed("item", "i1")
    found = [_as_itemsets(smaller, 1)]
    if max_k == 1:
        return found[0]

    kept = join_counted(rows, singles, ["item"], "cnt").select("basket", "item")
    led = _led(staged(_extend(kept), "basket-ranges"))
    for k in range(2, max_k + 1):
        if k > 2:
            led = _longer(led, smaller, k)
            if k < max_k:
                led = staged(led, f"led-{k}")
        counted = led.select(*_columns(k - 1), F.explode("tail").alias(f"i{k}"), "n")
        frequent = counted.groupBy(*_columns(k)).agg(F.sum("n").alias("cnt")).where(F.col("cnt") > bounds[k])
        if k > 2:
            frequent = has_frequent_subsets(frequent, smaller, k)
        smaller = staged(frequent, f"frequent-{k}")
        found.append(_as_itemsets(smaller, k))
    return reduce(DataFrame.unionByName, found)


def of_size(itemsets: DataFrame, k: int) -> DataFrame:
    return itemsets.where(F.col("k") == k)


def top_itemsets(itemsets: DataFrame, k: int, n: int = 10) -> DataFrame:
    """The n most frequent itemsets of size k; ties in item order."""
    return of_size(itemsets, k).orderBy(F.desc("cnt"), "items").limit(n)
