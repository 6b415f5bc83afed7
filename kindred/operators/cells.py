"""Rows compared block by block where very many of them meet: nothing is shuffled but the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one block; a cell holds two.
CELL_ROWS = 8192
# Blocks that are made of fewer rows, so that a small table is still many cells.
LEAST_BLOCKS, LEAST_ROWS = 8, 64
# Meetings, and pairs of rows, looked at together.
SLICE = 2_000_000


@dataclass
class Sides:
    """Both blocks of a cell: row numbers of the cell's table, and whether the two are one block."""

    left: np.ndarray
    right: np.ndarray
    same: bool


def n_blocks(n_rows: int) -> int:
    """Blocks that a table of so many rows is cut into."""
    return max(1, -(-n_rows // CELL_ROWS), min(LEAST_BLOCKS, n_rows // LEAST_ROWS))


def in_cells(
    rows: DataFrame,
    block: Column,
    blocks: int,
    compare: Callable[[pa.Table, Sides], Iterator[pa.Table]],
    schema: str,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """What ``compare`` finds in every cell of two blocks of ``rows`` (of equal ``by`` columns).

    ``block`` numbers the blocks from 0. A row goes to as many cells as there are blocks; a cell
    is a task's group of at most two blocks.
    """
    placed = rows.withColumn("_block", block.cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_other")
    )
    cells = placed.select(
        *rows.columns,
        "_block",
        F.least("_block", "_other").alias("_low"),
        F.greatest("_block", "_other").alias("_high"),
    )
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = [*by, "_low", "_high"]

    def found(table: pa.Table) -> pa.Table:
        low, high = table["_low"][0].as_py(), table["_high"][0].as_py()
        at = table["_block"].to_numpy()
        table = table.combine_chunks()
        sides = Sides(np.flatnonzero(at == low), np.flatnonzero(at == high), low == high)
        parts = list(compare(table, sides))
        return pa.concat_tables(parts) if parts else empty

    empty = pa.Table.from_batches([], schema=_arrow(schema))
    return cells.repartition(partitions, *cell).groupBy(*cell).applyInArrow(found, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    kinds["decimal(38,0)"] = pa.decimal128(38, 0)
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in schema.split(", "))])


def lists(column: pa.ChunkedArray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of number lists in the given rows, and for each value its place among these rows."""
    held = column.combine_chunks().take(pa.array(rows))
    offsets = held.offsets.to_numpy()
    values = held.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, np.repeat(np.arange(len(rows)), np.diff(offsets))


def shared(
    left: tuple[np.ndarray, np.ndarray], n_left: int, right: tuple[np.ndarray, np.ndarray], n_right: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (place left, place right) of lists that share a value, and how many they share."""
    order = np.argsort(right[0], kind="stable")
    values, places = right[0][order], right[1][order]
    start = np.searchsorted(values, left[0], "left")
    n = np.searchsorted(values, left[0], "right") - start
    first = np.searchsorted(left[1], np.arange(n_left + 1))
    before = np.concatenate([[0], np.cumsum(n)])[first]
    rows = max(1, SLICE // max(n_right, 1))
    low = 0
    while low < n_left:
        high = min(n_left, low + rows, max(low + 1, int(np.searchsorted(before, before[low] + SLICE, "right")) - 1))
        total = before[high] - before[low]
        if total:
            part = slice(first[low], first[high])
            met = np.repeat(start[part] - (np.cumsum(n[part]) - n[part]), n[part]) + np.arange(total)
            codes = np.repeat((left[1][part] - low) * n_right, n[part]) + places[met]
            counts = np.bincount(codes)
            hit = np.flatnonzero(counts)
            yield low + hit // n_right, hit % n_right, counts[hit]
        low = high


def apart(ids: pa.ChunkedArray, sides: Sides, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (places in both blocks) are to be counted: two ids, each pair once."""
    held = ids.to_numpy()
    a, b = held[sides.left[i]], held[sides.right[j]]
    return a < b if sides.same else a != b
