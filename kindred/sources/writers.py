"""Text sinks: baskets, itemset reports, rule reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.sources.readers import ITEM_SEPARATOR


def write_basket_lines(baskets: DataFrame, path: str) -> None:
    """One line per basket, items joined by a comma and a space."""
    baskets.select(F.array_join("items", ITEM_SEPARATOR).alias("value")).write.text(path)


def itemset_label(items: Column) -> Column:
    """``a`` for one item, ``('a', 'b')`` for more."""
    listed = F.concat(F.lit("('"), F.array_join(items, "', '"), F.lit("')"))
    return F.when(F.size(items) == 1, F.element_at(items, 1)).otherwise(listed)


def itemset_report(top: DataFrame, k: int) -> DataFrame:
    """Report lines of the given top itemsets of size k, title first."""
    title = top.sparkSession.range(1).select(
        F.lit(None).cast("bigint").alias("cnt"),
        F.array().cast("array<string>").alias("items"),
        F.lit(f"Top 10 frequent itemsets for k={k}:").alias("line"),
    )
    lines = top.select(
        "cnt", "items", F.concat_ws(": ", itemset_label(F.col("items")), "cnt").alias("line")
    )
    return title.unionByName(lines).orderBy(F.desc_nulls_first("cnt"), "items").select("line")


# Head of a rule report; the column line differs only in its padding.
RULE_HEAD = {
    2: "Association Rule\t  Std Lift\tLift  Confidence Interest",
    3: "Association Rule\t                   Std Lift\tLift  Confidence Interest",
}
RULE_LINE = "=" * 41


def rule_line(antecedent: Column, consequent: Column, *scores: Column) -> Column:
    """``antecedent -> consequent`` and the scores with four decimals, tab-separated.

    ``format_number`` rounds ties to even; ``format_string`` would round 0.15625 up.
    """
    rule = F.concat(itemset_label(antecedent), F.lit(" -> "), consequent)
    decimals = [F.call_function("format_number", score, F.lit("0.0000")) for score in scores]
    return F.concat_ws("\t", rule, *decimals)


def rule_report(rules: DataFrame, k: int) -> DataFrame:
    """Report lines of the rules of one level, strongest standardized lift first."""
    head = ["Association Rules", RULE_LINE, RULE_HEAD[k], RULE_LINE]
    titles = rules.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(line) for line in head])).alias("part", "line")
    )
    lines = rules.select(
        F.lit(len(head)).alias("part"),
        rule_line(
            F.col("antecedent"),
            F.col("consequent"),
            *[F.col(c) for c in ("std_lift", "lift", "confidence", "interest")],
        ).alias("line"),
        "std_lift",
        "antecedent",
        "consequent",
    )
    return (
        titles.unionByName(lines, allowMissingColumns=True)
        .orderBy("part", F.desc("std_lift"), "antecedent", "consequent")
        .select("line")
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ordered report lines; part files follow the order of the rows."""
    lines.write.text(path)


def write_quoted(rows: DataFrame, path: str, sep: str = ",") -> None:
    """A delimited file with a header row whose fields may hold separators, quotes and line breaks."""
    (
        rows.write.option("header", True)
        .option("sep", sep)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_with_head(lines: DataFrame, head: str, path: str) -> None:
    """Text files of the given lines, each of which begins with the head line."""
    names = head.split(",")
    (
        lines.select(F.col("value").alias(head))
        .write.option("header", True)
        .option("sep", "\0" if len(names) > 1 else ",")
        .option("quote", "")
        .csv(path)
    )
