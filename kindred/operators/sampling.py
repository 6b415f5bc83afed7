"""Samples. Hash samples pick the same rows on every engine and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.skew import spread_by

# Hex digits of an md5 that fit a 64-bit integer with room to spare.
HASH_DIGITS = 15


def stable_hash(*parts: Column | str) -> Column:
    """A number in [0, 16^15) that depends only on the parts' text, joined by colons."""
    text = F.concat_ws(":", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def bernoulli_sample(rows: DataFrame, fraction: float = 0.06, seed: int = 42) -> DataFrame:
    """Each row with the given chance, without replacement."""
    return rows.sample(False, fraction, seed)


def in_hash_percent(key: str, percent: int, seed: int = 42) -> Column:
    """Whether a key hashes into the first ``percent`` of 100 buckets."""
    return F.pmod(stable_hash(F.lit(seed), F.col(key)), F.lit(100)) < percent


def hash_percent_sample(rows: DataFrame, key: str, percent: int, seed: int = 42) -> DataFrame:
    """All rows whose key hashes into the first ``percent`` of 100 buckets.

    With a row id as key this samples rows, with a basket id whole baskets.
    """
    return rows.where(in_hash_percent(key, percent, seed))


def first_rows(rows: DataFrame, n: int, order: str = "doc_id") -> DataFrame:
    """The first n rows by ``order``."""
    return rows.orderBy(order).limit(n)


def random_rows(rows: DataFrame, n: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer) in the order of a seeded hash of the key."""
    return rows.orderBy(stable_hash(F.lit(seed), F.col(key)), key).limit(n)


def seeded_samples(
    rows: DataFrame, n: int, n_samples: int = 10, key: str = "doc_id"
) -> DataFrame:
    """``n_samples`` independent samples of n rows, told apart by ``seed``.

    Sample by sample the rows that ``random_rows`` takes with that seed, in one scan: rows are ranked
    by their hash for every seed, and each task keeps its first n of a seed before anything is
    shuffled.
    """
    seeds = F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("seed")
    drawn = rows.select("*", seeds).withColumn("_turn", stable_hash(F.col("seed"), F.col(key)))
    rank = F.row_number().over(Window.partitionBy("seed").orderBy("_turn", key))
    return (
        drawn.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", "_turn").select(*rows.columns, "seed")
    )


# Hash buckets that numbering is done within; each holds an even share of the ids.
NUMBER_BUCKETS = 65_536


def numbered(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add ``idx``, a gap-free number from 0, in the order of (hash bucket, key).

    Rows are ranked inside their bucket, and a running total over the fixed number
    of buckets gives each bucket its first number; there is no global sort.
    """
    placed = rows.withColumn("_bucket", F.pmod(stable_hash(key), F.lit(NUMBER_BUCKETS)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        placed.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_bucket")
        .withColumn("idx", (F.col("_start") + F.col("_rank") - 1).cast("bigint"))
        .drop("_bucket", "_rank", "_start")
    )


def random_pairs(
    rows: DataFrame, key: str = "doc_id", draws_per_row: int = 10, seed: int = 42
) -> DataFrame:
    """Distinct unordered pairs ``(x, y)`` from independent uniform draws of two rows.

    ``draws_per_row`` draws are made for every row of the table. Draws of a row with
    itself and repeats are dropped, so fewer pairs than draws come back.
    """
    ids = numbered(rows.select(key), key)
    total = rows.agg(F.count("*")).scalar()
    # Ids are few bytes, so adaptive merging would leave all draws to a task or two.
    draws = spread_by(ids.select("idx"), ["idx"]).select(
        F.explode(F.sequence(F.lit(0), F.lit(draws_per_row - 1))).alias("_turn"), "idx"
    ).select((F.col("idx") * draws_per_row + F.col("_turn")).alias("draw"))
    picks = draws.select(
        *[F.pmod(stable_hash(F.lit(seed), "draw", F.lit(side)), total).alias(f"i{side}")
          for side in ("x", "y")]
    ).where("ix <> iy")
    unordered = picks.select(
        F.least("ix", "iy").alias("ia"), F.greatest("ix", "iy").alias("ib")
    ).distinct()
    first = ids.select(F.col("idx").alias("ia"), F.col(key).alias("a"))
    second = ids.select(F.col("idx").alias("ib"), F.col(key).alias("b"))
    return (
        unordered.join(first, "ia")
        .join(second, "ib")
        .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    )
