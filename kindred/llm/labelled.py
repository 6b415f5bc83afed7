"""Bounded samples of labelled documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def sample_of_classes(
    rows: DataFrame, label: str, per_class: int, max_classes: int = 256, seed: str = "sample"
) -> DataFrame:
    """About ``per_class`` rows of each label, drawn by a seeded hash of ``doc_id``.

    Only the labels' counts come to the driver, of the ``max_classes`` most frequent
    labels; ``per_class * max_classes`` bounds the sample at any size of the input.
    """
    counts = (
        rows.where(F.col(label).isNotNull())
        .groupBy(label)
        .count()
        .orderBy(F.desc("count"), label)
        .limit(max_classes)
        .collect()
    )
    if not counts:
        return rows.limit(0)
    share = F.coalesce(
        *[
            F.when(F.col(label) == F.lit(row[label]), F.lit(min(1.0, per_class / row["count"])))
            for row in counts
        ],
        F.lit(0.0),
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return rows.where(draw < share)


def known_labels(labels: DataFrame, column: str, parts: int = 5) -> DataFrame:
    """``(doc_id, label)`` of labelled documents that are not held out, each once."""
    learned = labels.where(F.col(column).isNotNull() & (remainder(F.col("doc_id"), parts) != 0))
    return learned.select("doc_id", F.col(column).alias("label")).distinct()


def drawn_examples(docs: DataFrame, known: DataFrame, per_class: int, seed: str) -> DataFrame:
    """``(doc_id, text, label)`` of a sample of two classes of about ``per_class`` each.

    The labels are drawn before any text is looked at; their number is bounded by
    ``per_class``, so they are sent to the texts and only texts drawn are shuffled. An id that
    many rows carry gives one row a label, the shortest of its texts that are not
    empty, the least of equally long ones.
    """
    drawn = sample_of_classes(known, "label", per_class, 2, seed)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    size = F.octet_length("text")
    shortest = F.min(F.struct((size == 0).alias("empty"), size.alias("size"), "text"))
    one = found.where("text is not null").groupBy("doc_id", "label").agg(shortest.alias("least"))
    return one.select("doc_id", F.col("least.text").alias("text"), "label")


def kept_by_score(docs: DataFrame, score: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """Rows of ``docs`` whose ``score`` is good, in the columns of ``docs`` and without a join.

    The columns travel in one struct, so that none of them can clash with the score's.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return score(rows).where(keep).select("_row.*")
