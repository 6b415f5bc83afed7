"""Association rules with confidence, interest, lift and standardized lift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.itemsets import of_size

MIN_STD_LIFT = 0.2


def directed_rules(itemsets: DataFrame) -> DataFrame:
    """Every way to take one item of an itemset as the consequent of the others."""
    split = F.transform(
        F.col("items"),
        lambda item: F.struct(
            F.array_remove(F.col("items"), item).alias("antecedent"), item.alias("consequent")
        ),
    )
    return itemsets.select("k", F.col("cnt").alias("support_cnt"), F.inline(split))


def lowest_lift(px: Column, py: Column, n: Column) -> Column:
    """The least lift that two items of these supports can have."""
    return F.greatest(px + py - 1, 1 / n) / (px * py)


def lift_range(px: Column, py: Column, n: Column) -> Column:
    """Greatest less least possible lift; 1 where they coincide."""
    width = 1 / F.greatest(px, py) - lowest_lift(px, py, n)
    return F.when(width == 0, F.lit(1.0)).otherwise(width)


def _support_of(itemsets: DataFrame, k: int, key: str, cnt: str) -> DataFrame:
    items = F.col("items")[0] if k == 1 else F.col("items")
    return of_size(itemsets, k).select(items.alias(key), F.col("cnt").alias(cnt))


def association_rules(
    itemsets: DataFrame,
    n_baskets: int,
    k: int,
    metrics: str = "textbook",
    interest_base: str | None = None,
) -> DataFrame:
    """Rules from the frequent itemsets of size k.

    ``metrics="textbook"`` scores with supports as shares of the ``n_baskets``
    baskets. ``metrics="literal"`` scores as the market-basket script this follows
    does: bare counts in the standardized lift, and a lift that divides the
    confidence by the count of the antecedent's second element (for one antecedent
    item, the second character of its code), or by 1 where no such item is frequent.
    ``interest_base`` is ``"baskets"`` or ``"frequent_total"``, the summed counts of
    the frequent items; each metric mode has its own default.
    """
    literal = metrics == "literal"
    if interest_base is None:
        interest_base = "frequent_total" if literal else "baskets"
    how = "left" if literal else "inner"
    rules = directed_rules(of_size(itemsets, k))
    if k == 2:
        rules = rules.withColumn("_key", F.col("antecedent")[0])
    else:
        rules = rules.withColumn("_key", F.col("antecedent"))
    rules = rules.join(_support_of(itemsets, k - 1, "_key", "_cx"), "_key", how).join(
        _support_of(itemsets, 1, "consequent", "_cy"), "consequent", how
    )
    if literal:
        second = F.substring("_key", 2, 1) if k == 2 else F.col("antecedent")[1]
        rules = rules.withColumn("_second", second).join(
            _support_of(itemsets, 1, "_second", "_cs"), "_second", "left"
        )
    else:
        rules = rules.withColumn("_cs", F.lit(1))

    def or_one(name: str) -> Column:
        return F.coalesce(name, F.lit(1)).cast("double")

    n = F.lit(float(n_baskets))
    frequent_total = of_size(itemsets, 1).agg(F.sum("cnt")).scalar().cast("double")
    base = n if interest_base == "baskets" else frequent_total
    cx, cy = or_one("_cx"), or_one("_cy")
    confidence = F.col("support_cnt").cast("double") / cx
    lift = confidence / or_one("_cs") if literal else confidence / (cy / n)
    px, py = (cx, cy) if literal else (cx / n, cy / n)
    return rules.select(
        "k",
        "antecedent",
        "consequent",
        F.col("support_cnt").cast("bigint").alias("support_cnt"),
        confidence.alias("confidence"),
        (confidence - cy / base).alias("interest"),
        lift.alias("lift"),
        ((lift - lowest_lift(px, py, n)) / lift_range(px, py, n)).alias("std_lift"),
    )


def strong_rules(
    rules: DataFrame, min_std_lift: float = MIN_STD_LIFT, ordered: bool = True
) -> DataFrame:
    """Rules of at least the given standardized lift, strongest first unless ``ordered`` is false.

    A report sorts its lines itself and need not have its rules sorted before.
    """
    strong = rules.where(F.col("std_lift") >= min_std_lift)
    return strong.orderBy(F.desc("std_lift"), "antecedent", "consequent") if ordered else strong
