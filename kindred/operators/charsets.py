"""Character sets of documents, numbered by frequency and compared as words of bits."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.functions import charset
from kindred.operators import cells
from kindred.operators.skew import join_counted
from kindred.storage import staged

# Sets of one block, and characters in them; a cell holds two blocks.
BLOCK_SETS, BLOCK_CHARACTERS = 32_768, 1 << 21
# Blocks that are made of fewer sets, so that a small table is still many cells.
EVEN_BLOCKS, LEAST_SETS = 24, 256
# Tasks that cells are dealt to at most.
MOST_TASKS = 4096


def char_sets(rows: DataFrame) -> DataFrame:
    """``(chars, n_copies, numbers, size, w0.., rest)``, one row per distinct character set.

    ``rows`` have a ``chars`` string per document. Characters are numbered from 0, the one that most sets
    hold first: the bits of a set are those of its frequent characters, mostly few words, and ``numbers``,
    in falling order, begin with its rarest. The numbering is one row per character of the
    data, at most the 1,114,112 code points there are, so it can be broadcast and ranked in one task.
    """
    sets = staged(
        rows.where("chars <> ''").groupBy("chars").agg(F.count("*").alias("n_copies")), "char-sets"
    )
    tokens = sets.select("chars", F.explode(F.split("chars", "")).alias("char"))
    frequent_first = Window.orderBy(F.desc("df"), "char")
    numbers = (
        tokens.groupBy("char")
        .agg(F.count("*").alias("df"))
        .select("char", (F.row_number().over(frequent_first) - 1).alias("number"))
    )
    number = F.col("number")
    numbered = (
        tokens.join(F.broadcast(numbers), "char")
        .groupBy("chars")
        .agg(
            F.sort_array(F.collect_list(number), asc=False).alias("numbers"),
            *[F.coalesce(F.bit_or(charset.word_of(number, k)), F.lit(0).cast("long")).alias(f"w{k}")
              for k in range(charset.WORDS)],
        )
    )
    outside = F.filter("numbers", lambda n: n >= charset.WORDS * charset.BITS)
    return staged(
        sets.join(numbered, "chars").withColumns({"size": F.size("numbers"), "rest": outside}),
        "numbered-sets",
    )


def with_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` with the set columns of their ``chars``, which no empty string has."""
    wanted = sets.select("chars", F.col("n_copies").alias("_n"), *charset.COLUMNS)
    return join_counted(rows, wanted, ["chars"], "_n").drop("_n")


def with_char_similarity(pairs: DataFrame, described: DataFrame, name: str = "sim") -> DataFrame:
    """Add the similarity of the character sets of each pair; ``described`` has set columns by ``doc_id``."""
    sides = {}
    for side in ("x", "y"):
        held = described.select(
            F.col("doc_id").alias(side), F.struct(*charset.COLUMNS).alias(f"_of_{side}")
        )
        pairs = pairs.join(held, side)
        sides[side] = lambda c, side=side: F.col(f"_of_{side}.{c}")
    return pairs.withColumn(name, charset.similarity(sides["x"], sides["y"])).drop("_of_x", "_of_y")


def _in_size_blocks(
    rows: DataFrame,
    threshold: float,
    compare: Callable[[pa.Table, cells.Sides], Iterator[pa.Table]],
    schema: str,
) -> DataFrame:
    """What ``compare`` finds in every cell of two blocks of ``rows``, which have set columns.

    Blocks are ranges of set sizes, or parts of one size, and only blocks whose sizes allow the threshold meet. A
    block is packed into one row and holds at most BLOCK_SETS sets and BLOCK_CHARACTERS characters (or one set), so a
    cell is bounded whatever the table. Rows of ``compare`` leave the task as they come. Only the number
    of sets of each size goes through the driver.
    """
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = sorted(map(tuple, rows.groupBy("size").agg(F.count("*")).collect()))
    places, reach = size_blocks(counts, threshold)
    placed = rows.join(F.broadcast(_listed(spark, places, ["size", "_first", "_parts"])), "size").withColumn(
        "_block", F.col("_first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_parts")).cast("int")
    )

    def packed(table: pa.Table) -> pa.Table:
        block = table["_block"][0].as_py()
        sink = pa.BufferOutputStream()
        held = table.drop_columns(["_block"]).sort_by("size").combine_chunks()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, held.schema, options=options) as writer:
            writer.write_table(held)
        packs = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        return pa.table({"_block": pa.array([block], pa.int32()), "held": packs})

    blocks = staged(
        placed.select(*rows.columns, "_block")
        .repartition(partitions, "_block")
        .groupBy("_block")
        .applyInArrow(packed, "_block int, held binary"),
        "set-blocks",
    )
    met = (
        blocks.join(F.broadcast(_listed(spark, reach, ["_block", "_from", "_to"])), "_block")
        .select("_block", "held", F.explode(F.sequence("_from", "_to")).alias("_other"))
        .select(F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"), "held")
    )
    n_cells = sum(to - block + 1 for block, _, to in reach)

    def found(batches):
        first = None
        for batch in batches:
            for low, high, held in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                block = pa.ipc.open_stream(held).read_all()
                if low == high:
                    rows = np.arange(len(block))
                    table, sides = block, cells.Sides(rows, rows, True)
                elif first is None or first[:2] != (low, high):
                    first = low, high, block
                    continue
                else:
                    n = len(first[2])
                    table = pa.concat_tables([first[2], block])
                    sides = cells.Sides(np.arange(n), np.arange(n, len(table)), False)
                for part in compare(table, sides):
                    yield from part.to_batches(cells.SLICE)

    cell = ["_low", "_high"]
    return (
        met.repartition(max(partitions, min(n_cells, MOST_TASKS)), *cell)
        .sortWithinPartitions(*cell)
        .mapInArrow(found, schema)
    )


def _listed(spark: SparkSession, rows: list[tuple[int, ...]], names: list[str]) -> DataFrame:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int32()) for n, c in zip(names, columns, strict=True)}))


def size_blocks(
    counts: Sequence[tuple[int, int]], threshold: float
) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Blocks for sets of ``(size, number)`` in order: ``(size, first block, blocks)`` and ``(block, from, to)``.

    The latter are the blocks whose sizes allow the threshold together with those of a block.
    """
    total = sum(n for _, n in counts)
    most = min(BLOCK_SETS, max(LEAST_SETS, -(-total // EVEN_BLOCKS)))
    places, ends, held = [], [], 0
    for size, n in counts:
        limit = max(1, min(most, BLOCK_CHARACTERS // size))
        parts = -(-n // limit)
        if parts > 1 or not ends or held + n > limit:
            places.append((size, len(ends), parts))
            ends += [[size, size] for _ in range(parts)]
            held = limit if parts > 1 else n
        else:
            places.append((size, len(ends) - 1, 1))
            ends[-1][1] = size
            held += n
    starts, start = [], 0
    for least, _ in ends:
        while ends[start][1] < least * threshold - 1e-6:
            start += 1
        starts.append(start)
    return places, [(b, start, bisect_right(starts, b) - 1) for b, start in enumerate(starts)]


def similar_copies(sets: DataFrame, threshold: float) -> DataFrame:
    """``(between)``: partial sums of the pairs of documents of distinct sets whose similarity exceeds ``threshold``."""

    def compare(table: pa.Table, sides: cells.Sides):
        words, copies, between = charset.Words(table), table["n_copies"].to_numpy(), 0
        for i, j, sim in words.alike(sides.left, sides.right, sides.same, threshold):
            over = sim > threshold
            between += charset.product_sum(copies[i[over]], copies[j[over]])
        yield pa.table({"between": pa.array([Decimal(between)], pa.decimal128(38, 0))})

    return _in_size_blocks(sets.select("n_copies", *charset.COLUMNS), threshold, compare, "between decimal(38,0)")


def similar_rows(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``(x, y, sim)`` of all rows with unlike ids, ``(doc_id, chars)``, whose sets reach ``threshold``.

    Nothing but the sets is shuffled; pairs leave the task that finds them.
    """
    described = staged(with_sets(rows.where("doc_id is not null"), sets).drop("chars"), "described")

    def compare(table: pa.Table, sides: cells.Sides):
        words, ids = charset.Words(table), table["doc_id"].to_numpy()
        for i, j, sim in words.alike(sides.left, sides.right, sides.same, threshold):
            x, y = ids[i], ids[j]
            unlike = x != y
            x, y = x[unlike], y[unlike]
            yield pa.table({"x": np.minimum(x, y), "y": np.maximum(x, y), "sim": sim[unlike]})

    kind = dict(rows.dtypes)["doc_id"]
    columns = described.select("doc_id", *charset.COLUMNS)
    return _in_size_blocks(columns, threshold, compare, f"x {kind}, y {kind}, sim double")
