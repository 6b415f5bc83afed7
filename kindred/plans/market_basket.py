"""Market-basket queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators import baskets, itemsets, rules, sampling
from kindred.plans.tables import event_rows, order_rows, table
from kindred.sources import readers, writers
from kindred.storage import fresh_path, staged

# Least support, as a fraction of the baskets, per itemset size.
ORDER_SUPPORT = {1: 0.14, 2: 0.02, 3: 0.0034}
EVENT_SUPPORT = {1: 0.3, 2: 0.1, 3: 0.02}

SCORES = ("confidence", "interest", "lift", "std_lift")


def mined(
    rows: DataFrame, support: dict[int, float], max_k: int = 3
) -> tuple[DataFrame, int]:
    """Frequent itemsets of basket rows, and the number of baskets."""
    rows = staged(rows, "basket-rows")
    n_baskets = baskets.count_baskets(rows)
    return itemsets.frequent_itemsets(rows, support, max_k, n_baskets), n_baskets


def order_itemsets(spark: SparkSession, sf_dir: str, max_k: int = 3) -> DataFrame:
    return mined(order_rows(spark, sf_dir), ORDER_SUPPORT, max_k)[0]


def _joined(found: DataFrame) -> DataFrame:
    return found.withColumn("items", F.array_join("items", ", "))


def frequent_items_k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(order_itemsets(spark, sf_dir, 1)).select("items", "cnt")


def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_itemsets(spark, sf_dir, 2)
    return _joined(itemsets.of_size(found, 2)).select("items", "cnt")


def frequent_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_itemsets(spark, sf_dir, 3)
    return _joined(itemsets.of_size(found, 3)).select("items", "cnt")


def frequent_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels in one table, over the event baskets."""
    return _joined(mined(event_rows(spark, sf_dir), EVENT_SUPPORT)[0])


def top_report(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Report of the ten most frequent itemsets of size k."""
    found = order_itemsets(spark, sf_dir, k)
    return writers.itemset_report(itemsets.top_itemsets(found, k), k)


def order_rules(spark: SparkSession, sf_dir: str, k: int, metrics: str) -> DataFrame:
    found, n_baskets = mined(order_rows(spark, sf_dir), ORDER_SUPPORT, k)
    return rules.association_rules(found, n_baskets, k, metrics)


def rules_table(spark: SparkSession, sf_dir: str, k: int, metrics: str) -> DataFrame:
    scored = order_rules(spark, sf_dir, k, metrics)
    return scored.select(
        F.array_join("antecedent", ", ").alias("antecedent"),
        "consequent",
        "support_cnt",
        *[F.round(score, 6).alias(score) for score in SCORES],
    )


def rules_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of both sizes that reach the least standardized lift, textbook scores."""
    found, n_baskets = mined(order_rows(spark, sf_dir), ORDER_SUPPORT)
    kept = [
        rules.strong_rules(rules.association_rules(found, n_baskets, k), ordered=False) for k in (2, 3)
    ]
    return kept[0].unionByName(kept[1]).select(
        "k",
        F.array_join("antecedent", ", ").alias("antecedent"),
        "consequent",
        F.round("std_lift", 6).alias("std_lift"),
    )


def rule_report(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    scored = order_rules(spark, sf_dir, k, "literal")
    return writers.rule_report(rules.strong_rules(scored, ordered=False), k)


def event_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = baskets.basket_arrays(event_rows(spark, sf_dir))
    return built.withColumn("items", F.array_join("items", ", "))


def basket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.basket_sizes(order_rows(spark, sf_dir))


def basket_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items counted over a sample of 6 % of whole baskets."""
    rows = sampling.hash_percent_sample(event_rows(spark, sf_dir), "basket", 6)
    return baskets.basket_arrays(rows).withColumn("items", F.array_join("items", ", "))


def row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets built from a sample of 6 % of the rows."""
    events = sampling.hash_percent_sample(table(spark, sf_dir, "events"), "event_id", 6)
    rows = baskets.basket_rows(
        events.withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type"
    )
    return baskets.basket_arrays(rows).withColumn("items", F.array_join("items", ", "))


def bernoulli_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.bernoulli_sample(table(spark, sf_dir, "events")).select(
        "event_id", "user_id", "event_type"
    )


def bernoulli_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a Bernoulli sample whatever the random numbers: its rows are rows of the
    table, each at most once, and about 6 % of them, within six standard deviations."""
    events = table(spark, sf_dir, "events")
    taken = sampling.bernoulli_sample(events).select("event_id", F.lit(1).alias("taken"))
    counted = events.groupBy("event_id").agg(F.count("*").alias("n")).join(
        taken.groupBy("event_id").agg(F.sum("taken").alias("n_taken")), "event_id", "full_outer"
    )
    n, n_taken = F.sum("n"), F.coalesce(F.sum("n_taken"), F.lit(0))
    return counted.agg(
        n.alias("n_rows"),
        F.count_if(F.col("n").isNull()).alias("n_foreign"),
        F.count_if(F.col("n_taken") > F.col("n")).alias("n_repeated"),
        (F.abs(n_taken - n * 0.06) <= 6 * F.sqrt(n * 0.06 * 0.94)).alias("share_holds"),
    )


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in all, rows in the hash sample, baskets of the sample; all from one scan."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    taken = sampling.in_hash_percent("event_id", 6)
    basket = F.struct("user_id", F.to_date("ts").alias("day"))
    return events.agg(
        F.count("*").alias("n_rows"),
        F.count_if(taken).alias("n_sampled"),
        F.count_distinct(F.when(taken, basket)).alias("n_baskets"),
    )


def csv_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as a condition file with header, read back, counted per code."""
    path = fresh_path(spark, "conditions")
    events = table(spark, sf_dir, "events")
    events.select(
        F.col("event_id").alias("ID"),
        F.col("user_id").alias("PATIENT"),
        F.col("event_type").alias("CODE"),
    ).write.option("header", True).option("compression", "gzip").csv(path)
    rows = baskets.basket_rows(readers.read_conditions(spark, path), "PATIENT", "CODE")
    return itemsets.count_items(rows)


def basket_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order baskets written as text lines, read back, counted by size."""
    path = fresh_path(spark, "baskets")
    writers.write_basket_lines(baskets.basket_arrays(order_rows(spark, sf_dir)), path)
    lines = readers.read_basket_lines(spark, path)
    return lines.groupBy(F.array_join("items", ", ").alias("items")).agg(
        F.count("*").alias("n_baskets")
    )


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Itemset and rule reports written as text files and read back."""
    path = fresh_path(spark, "reports")
    found, n_baskets = mined(order_rows(spark, sf_dir), ORDER_SUPPORT)
    for k in (1, 2, 3):
        top = itemsets.top_itemsets(found, k)
        writers.write_lines(writers.itemset_report(top, k), f"{path}/itemsets_k_{k}")
    for k in (2, 3):
        scored = rules.association_rules(found, n_baskets, k, "literal")
        report = writers.rule_report(rules.strong_rules(scored, ordered=False), k)
        writers.write_lines(report, f"{path}/rules_k_{k}")
    return spark.read.text([f"{path}/itemsets_k_{k}" for k in (1, 2, 3)]).withColumnRenamed(
        "value", "line"
    ).unionByName(
        spark.read.text([f"{path}/rules_k_{k}" for k in (2, 3)]).withColumnRenamed("value", "line")
    )
