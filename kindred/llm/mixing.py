"""Mix sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.storage import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw_order(doc_id: Column, seed: str = SEED) -> Column:
    """Seeded hexadecimal key by which documents are drawn; a null id counts as empty."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def water_fill(
    totals: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    share: float = 1.0,
) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``, one row per source.

    Sources weigh ``weights`` in turn, by code point, null last, and share ``share`` of
    all sizes. No target exceeds ``max_epochs`` times its source; what is cut off
    goes to the others by weight, until none is above. Filling by rising ratio of cap to
    weight reaches that state directly: a source is capped if its ratio lies below the
    level that all sources not yet capped would get. Both windows run over one row
    per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    cap = F.col("source_size") * F.lit(max_epochs)
    filled = totals.select(
        "*",
        F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("_weight"),
        cap.alias("_cap"),
    ).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    rising = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ) / F.sum("_weight").over(onward)
    filled = filled.withColumn("_level", level)
    reached = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level")))
    filled = filled.withColumn("_final", reached.over(everything)["_level"])
    target = F.least(
        F.col("_cap").cast("double"),
        F.coalesce(F.col("_final") * F.col("_weight"), F.col("_cap").cast("double")),
    )
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    share: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, repetitions, taken)`` per document.

    Every document of a source is taken ``floor(target / source_size)`` times whole.
    For the fraction left, documents are taken once more in a seeded order until the
    source's missing words are reached to within half a document. The order is by
    digest, so the first three digits give 4096 parts of a source: running
    totals over the parts tell which are taken or left whole, and only the part in which the
    target falls is ordered row by row. No source is ever sorted in one task.

    Null texts have size 0 and are taken 0 words; a null source is a source of its own; a
    null id is drawn as an empty one; repeated rows are documents of their own, and
    which of two equal rows is taken makes no difference. An empty table gives no rows.
    Other columns of ``docs`` are ignored.
    """
    sizes = staged(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            draw_order(F.col("doc_id"), seed).alias("_key"),
        ),
        "sizes",
    ).withColumn("_part", F.substring("_key", 1, 3))
    parts = staged(
        sizes.groupBy("source", "_part").agg(F.sum("size").alias("_part_size")), "part-sizes"
    )
    totals = parts.groupBy("source").agg(F.sum("_part_size").alias("source_size"))
    targets = water_fill(totals, weights, max_epochs, share)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")
    targets = targets.withColumn("_whole", whole).withColumn(
        "_missing", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    earlier = (
        Window.partitionBy("source")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cut = parts.withColumn("_to", F.sum("_part_size").over(earlier)).withColumnRenamed("source", "_s")
    cut = cut.join(targets, F.col("_s").eqNullSafe(F.col("source"))).select(
        F.col("_s"),
        F.col("_part").alias("_p"),
        "source_size",
        "target",
        "_whole",
        "_missing",
        (F.col("_to") - F.col("_part_size")).alias("_from"),
        "_to",
    )
    cut = staged(cut, "cut")
    placed = sizes.join(cut, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
    split = (F.col("_from") < F.col("_missing")) & (F.col("_missing") < F.col("_to"))
    within = Window.partitionBy("source", "_part").orderBy("_key", "size")
    running = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    extra_whole = placed.where(~split).withColumn("_extra", F.col("_to") <= F.col("_missing"))
    extra_split = placed.where(split).withColumn(
        "_extra", F.col("_from") + running - F.col("size") / 2 < F.col("_missing")
    )
    drawn = extra_whole.unionByName(extra_split).withColumn(
        "repetitions", F.col("_whole") + F.col("_extra").cast("long")
    )
    return drawn.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "repetitions",
        (F.col("repetitions") * F.col("size")).alias("taken"),
    )


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as it was taken, with its number ``repetition``.

    ``doc_id`` must be unique in ``docs``. Documents taken 0 times are left out.
    """
    times = mixed.where("repetitions > 0").select(
        F.col("doc_id").alias("_id"), F.sequence(F.lit(1), F.col("repetitions").cast("int")).alias("_times")
    )
    joined = docs.join(times, F.col("doc_id").eqNullSafe(F.col("_id")))
    return joined.select(*docs.columns, F.explode("_times").alias("repetition"))
