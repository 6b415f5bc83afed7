"""Joins and pairings that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.storage import staged

# A key is heavy when it holds more than 1/HEAVY_SHARE of the counted rows, or more than an even
# share of a shuffle where that has more partitions; so there are fewer heavy keys than the greater
# of these numbers whatever the size of the data.
HEAVY_SHARE = 1000

# Rows of one group paired within one join cell.
BLOCK_ROWS = 4096


def join_counted(
    rows: DataFrame, counted: DataFrame, keys: Sequence[str], count_col: str
) -> DataFrame:
    """Inner join of ``rows`` to ``counted``, a table with one row per key.

    ``count_col`` tells how many rows hold the key. The few heavy keys (fewer than
    HEAVY_SHARE, or than shuffle partitions if those are more) are broadcast and their rows stay where
    they are; only light keys, each no more than a task's share of the data, are shuffled.
    """
    keys = list(keys)
    total = counted.agg(F.sum(count_col)).scalar()
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_heavy = F.col(count_col) * max(HEAVY_SHARE, partitions) > total
    heavy = F.broadcast(counted.where(is_heavy))
    light = counted.where(~is_heavy)
    return rows.join(heavy, keys).unionByName(
        rows.join(heavy.select(*keys), keys, "left_anti").join(light, keys)
    )


def balanced(rows: DataFrame, key: str) -> DataFrame:
    """Spread a scan over as many tasks as the session setting ``spark.kindred.spread`` names.

    Without that setting, the default, a scan stays as it is, and no text is shuffled
    before it is hashed. It helps where a table is one small file that Spark cannot
    split, as cutting up and hashing text takes far longer than reading it.
    """
    spread = rows.sparkSession.conf.get("spark.kindred.spread", None)
    return rows.repartition(int(spread), key) if spread else rows


def spread_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash rows by the keys into the session's full number of shuffle partitions.

    For inputs of a self-join whose work grows faster than their size: adaptive
    merging of small partitions would leave all of it to a few tasks.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, *keys)


def meetings(
    members: DataFrame,
    keys: Sequence[str],
    id_col: str = "doc_id",
    carry: Sequence[str] = (),
    keep: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every meeting of two ids under a key: the keys, ``_a``, ``_b`` and both sides' ``carry`` columns.

    ``members`` holds each (keys, id) once; two ids meet under every key that both have, so as pairs they
    come more than once. A group of more than ``block_rows`` ids is cut into blocks, and every two
    blocks meet in a join cell of their own, so a large group spreads over many tasks and no
    list of its members is ever built. Members alone in their group, often nearly all, are
    dropped before anything is stored or paired. ``keep`` tests a meeting inside the join, by
    its ``carry`` columns: a meeting that fails is never written out, and one that is summed up at once
    never leaves its task.
    """
    keys, carry = list(keys), list(carry)
    groups = members.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    sized = staged(join_counted(members, groups, keys, "_n"), "grouped")
    blocks = F.ceil(F.col("_n") / block_rows).cast("int")
    placed = sized.select(
        *keys,
        F.col(id_col).alias("_id"),
        *carry,
        blocks.alias("_blocks"),
        F.pmod(F.xxhash64(id_col), blocks).cast("int").alias("_block"),
    )
    left = placed.select(
        *keys,
        F.col("_id").alias("_a"),
        *[F.col(c).alias(f"_a_{c}") for c in carry],
        F.col("_block").alias("_low"),
        F.explode(F.sequence("_block", F.col("_blocks") - 1)).alias("_high"),
    )
    right = placed.select(
        *keys,
        F.col("_id").alias("_b"),
        *[F.col(c).alias(f"_b_{c}") for c in carry],
        F.explode(F.sequence(F.lit(0), "_block")).alias("_low"),
        F.col("_block").alias("_high"),
    )
    cell = [*keys, "_low", "_high"]
    met = (
        spread_by(left, cell)
        .join(spread_by(right, cell), cell)
        .where("_low < _high or _a < _b")
    )
    if keep is not None:
        met = met.where(keep(_side("a"), _side("b")))
    return met


def _side(which: str) -> Callable[[str], Column]:
    return lambda column: F.col(f"_{which}_{column}")


def pairs_sharing_key(
    members: DataFrame,
    keys: Sequence[str],
    id_col: str = "doc_id",
    within: Sequence[str] = (),
    carry: Sequence[str] = (),
    keep: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    block_rows: int = BLOCK_ROWS,
    needed: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
) -> DataFrame:
    """Unordered pairs of ids found together under at least one key.

    Returns ``within`` columns, ``x``, ``y`` (x < y) and ``n_shared``, the number
    of keys the two share, at least as many as ``needed`` says from both sides' ``carry`` columns;
    the other arguments are those of ``meetings``.
    """
    met = meetings(members, keys, id_col, carry, keep, block_rows)
    pairs = met.groupBy(*within, F.least("_a", "_b").alias("x"), F.greatest("_a", "_b").alias("y"))
    n_shared = F.count("*").alias("n_shared")
    if needed is None:
        return pairs.agg(n_shared)
    least = F.min(needed(_side("a"), _side("b"))).alias("_needed")
    return pairs.agg(n_shared, least).where("n_shared >= _needed").drop("_needed")


def sums_of_pairs(
    members: DataFrame,
    keys: Sequence[str],
    sums: Callable[[Callable[[str], Column], Callable[[str], Column]], Sequence[Column]],
    first: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    id_col: str = "doc_id",
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over pairs of ids that share a key, without a list of the pairs.

    ``first`` tells, from the keys and both sides' ``carry`` columns, whether a meeting is the one under the
    first key that the two share; only there is a pair looked at, so that it counts once and nothing need be
    made distinct. ``sums`` are aggregates over such pairs for each value of the ``by`` columns, which are
    among the keys. Joins carry members only; what is shuffled after them are partial sums.
    """
    met = meetings(members, keys, id_col, carry, first, block_rows)
    return met.groupBy(*by).agg(*sums(_side("a"), _side("b")))
