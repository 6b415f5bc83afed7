"""Classes of candidates: documents connected by shared buckets, without a list of pairs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.banding import band_keys, band_rows
from kindred.operators.components import connected
from kindred.operators.skew import join_counted
from kindred.storage import staged

# Texts of one side of a cell in which links are counted.
CELL_TEXTS = 4096


def bucket_stars(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(a, b)``: every member of a bucket with the bucket's least member.

    They connect a bucket as its pairs do, with one edge per member; a large bucket is no group anywhere.
    """
    keys = list(keys)
    least = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("doc_id").alias("b")).where("_n > 1")
    stars = join_counted(rows.select(*keys, "doc_id"), least, keys, "_n")
    return stars.where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()


def linked_pairs(keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row of ``left``, how many rows of ``right`` have an equal key in any band.

    ``keys`` has a row per text and a column per band; the other two are row numbers. Partners are a
    bitmap per text: that of its bucket in each band, put together by OR.
    """
    met = np.zeros((len(left), -(-len(right) // 8)), np.uint8)
    place, bit = np.arange(len(right)) >> 3, np.uint8(1) << (np.arange(len(right)) & 7).astype(np.uint8)
    for column in keys.T:
        there, code = np.unique(column[right], return_inverse=True)
        bitmaps = np.zeros((len(there) + 1, met.shape[1]), np.uint8)
        np.bitwise_or.at(bitmaps, (code, place), bit)
        at = np.minimum(np.searchsorted(there, column[left]), len(there) - 1)
        at[there[at] != column[left]] = len(there)
        np.bitwise_or(met, bitmaps[at], out=met)
    return np.bitwise_count(met).sum(axis=1, dtype=np.int64)


def class_links(keyed: DataFrame, sizes: DataFrame, cell_texts: int = CELL_TEXTS) -> DataFrame:
    """``(class_id, n_links)``: pairs of texts of a class that have an equal key in any band.

    ``keyed`` has ``(class_id, doc_id, keys)``, keys as an array of numbers; ``sizes`` has
    ``(class_id, n_texts)``. A class of more than ``cell_texts`` is cut into blocks, and every two blocks meet in a
    cell; smaller ones share cells, as texts of two classes have no key in common. A cell holds
    bitmaps and gives one row per class, so no pair is a row anywhere.
    """
    sizes = sizes.where("n_texts > 1")
    small = sizes.where(F.col("n_texts") <= cell_texts).agg(F.sum("n_texts")).scalar()
    packs = F.greatest(F.ceil(F.coalesce(small, F.lit(0)) / cell_texts), F.lit(1)).cast("long")
    blocks = F.ceil(F.col("n_texts") / cell_texts).cast("int")
    placed = join_counted(keyed, sizes, ["class_id"], "n_texts").select(
        "class_id",
        "keys",
        F.when(blocks > 1, F.col("class_id")).alias("_class"),
        F.when(blocks == 1, F.pmod(F.xxhash64("class_id"), packs)).alias("_pack"),
        blocks.alias("_blocks"),
        F.pmod(F.xxhash64("doc_id"), blocks).cast("int").alias("_block"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    cells = placed.select("*", other).select(
        "class_id",
        "keys",
        "_block",
        "_class",
        "_pack",
        F.least("_block", "_other").alias("_low"),
        F.greatest("_block", "_other").alias("_high"),
    )

    def counted(cell: pa.Table) -> pa.Table:
        low, high = cell["_low"][0].as_py(), cell["_high"][0].as_py()
        block = cell["_block"].to_numpy()
        keys = cell["keys"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(block), -1)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        ids = cell["class_id"].to_numpy()[left]
        found = linked_pairs(keys, left, right) if len(right) else np.zeros(len(left), np.int64)
        classes, place = np.unique(ids, return_inverse=True)
        links = np.zeros(len(classes), np.int64)
        np.add.at(links, place, found - 1 if low == high else found)
        return pa.table({"class_id": classes, "n_links": links // 2 if low == high else links})

    return (
        cells.groupBy("_class", "_pack", "_low", "_high")
        .applyInArrow(counted, "class_id long, n_links long")
        .groupBy("class_id")
        .agg(F.sum("n_links").alias("n_links"))
    )


def candidate_classes(
    signed: DataFrame, g: int, r: int, n_hashes: int
) -> tuple[DataFrame, DataFrame]:
    """Members and classes of distinct texts that are connected by shared buckets.

    ``signed`` has ``(doc_id, n_copies, signature)``. The first table has ``(doc_id, class_id)`` of every text,
    one that shares no bucket with another under its own id; the id of a class is its least document. The second
    has ``(class_id, n_texts, n_documents, n_links)``: links are pairs of texts that share a bucket, each counted once.
    """
    rows = staged(band_rows(signed, g, r, n_hashes), "class-rows")
    found = staged(connected(bucket_stars(rows, ["band", "key"])), "connected")
    node = found.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))
    members = staged(
        signed.select("doc_id", "n_copies")
        .join(node, "doc_id", "left")
        .withColumn("class_id", F.coalesce("class_id", "doc_id")),
        "class-members",
    )
    # Only equality matters from here on, so a key is 64 bits of hash.
    hashed = F.transform(band_keys(n_hashes, g, r), lambda key: F.xxhash64(key))
    keyed = signed.select("doc_id", hashed.alias("keys")).join(node, "doc_id")
    sizes = staged(
        members.groupBy("class_id").agg(
            F.count("*").alias("n_texts"), F.sum("n_copies").alias("n_documents")
        ),
        "class-sizes",
    )
    links = class_links(keyed, sizes.select("class_id", "n_texts"))
    classes = sizes.join(links, "class_id", "left").withColumn(
        "n_links", F.coalesce("n_links", F.lit(0))
    )
    return members.select("doc_id", "class_id"), classes
