"""Table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.baskets import basket_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket rows of orders and the brands in them."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return basket_rows(
        lines.join(parts, lines.l_partkey == parts.p_partkey), "l_orderkey", "p_brand"
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket rows of a user's day and the event types in it."""
    events = table(spark, sf_dir, "events")
    return basket_rows(
        events.withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type"
    )
