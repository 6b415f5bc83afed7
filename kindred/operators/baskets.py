"""Baskets in long form: one row per basket and distinct item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def basket_rows(rows: DataFrame, basket: str | list[str], item: str) -> DataFrame:
    """Distinct ``(basket, item)`` rows.

    Repeats are removed before the shuffle, and the shuffle key holds the item, so
    a basket with very many rows does not land in one task. Several key columns
    make one basket key joined by ``|``.
    """
    if isinstance(basket, str):
        key = F.col(basket)
    else:
        key = F.concat_ws("|", *[F.col(c).cast("string") for c in basket])
    return (
        rows.select(key.alias("basket"), F.col(item).cast("string").alias("item"))
        .dropna()
        .distinct()
    )


def explode_baskets(baskets: DataFrame) -> DataFrame:
    """Long form of ``(basket_id, items)`` rows."""
    return baskets.select(
        F.col("basket_id").alias("basket"), F.explode(F.array_distinct("items")).alias("item")
    )


def basket_arrays(rows: DataFrame) -> DataFrame:
    """``(basket_id, items)`` with sorted items, for the text sink and for viewing.

    A basket holds each item once, so its array is no longer than the item
    catalogue; the mining operators work on the long form and need no arrays.
    """
    return (
        rows.groupBy("basket")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .withColumnRenamed("basket", "basket_id")
    )


def basket_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("basket").agg(F.count("*").alias("n_items"))


def count_baskets(rows: DataFrame) -> int:
    """Number of baskets; only that comes to the driver."""
    return rows.select("basket").distinct().count()
