"""Stored band index: documents' bands on disk by key range, asked by text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.minhash import minhash_signature
from kindred.functions.text import jaccard, shingle_set
from kindred.operators.banding import N_HASHES, SHINGLE, band_keys, effective_bands
from kindred.operators.skew import balanced
from kindred.storage import staged

ENTRIES = "part int, key binary, text_key binary"
MEMBERS = "text_key binary, doc_id {}"


@dataclass(frozen=True)
class BandIndex:
    """Where an index lies and how its documents are cut up.

    ``entries`` of the folder has a row per band and distinct text, in one folder for each ``part``: a band and one of
    ``slots`` ranges of its keys. ``members`` has the documents of each text. There are ``bands * slots``
    parts, whatever the number of documents; ``files`` are written per part and append.
    """

    path: str
    b: int
    r: int
    n_hashes: int = N_HASHES
    k: int = SHINGLE
    slots: int = 16
    files: int = 1
    id_type: str = "bigint"

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(ENTRIES).parquet(f"{self.path}/entries")

    def members(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(MEMBERS.format(self.id_type)).parquet(f"{self.path}/members")

    def _part(self, band: Column, key: Column) -> Column:
        """The band's part that holds the key's range, from its first two bytes."""
        first = F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")
        return (band * self.slots + F.floor(first * self.slots / 65_536)).cast("int")

    def keyed(self, texts: DataFrame, *ids: str) -> DataFrame:
        """``(*ids, text_key, keys)`` of the texts long enough for a shingle."""
        g = effective_bands(self.n_hashes, self.b, self.r)
        signature = minhash_signature(F.col("text"), self.n_hashes, self.k)
        return (
            texts.where(F.length("text") >= self.k)
            .select(*ids, F.unhex(F.sha2("text", 256)).alias("text_key"), signature.alias("signature"))
            .select(*ids, "text_key", band_keys(self.n_hashes, g, self.r).alias("keys"))
        )

    def placed(self, keyed: DataFrame, *kept: str) -> DataFrame:
        """``(part, key, *kept)``, a row for each band."""
        bands = keyed.select(*kept, F.posexplode("keys").alias("band", "key"))
        return bands.select(self._part(F.col("band"), F.col("key")).alias("part"), "key", *kept)


def append(index: BandIndex, docs: DataFrame) -> None:
    """Add ``(doc_id, text)`` rows to the index; only new files are written.

    Of equal texts in one append one is entered, with all its documents; a text entered by an earlier
    append is entered again and found once. Documents without a shingle are not entered.
    """
    keyed = staged(index.keyed(balanced(docs, "doc_id"), "doc_id"), "index-keys")
    keyed.select("text_key", "doc_id").write.mode("append").parquet(f"{index.path}/members")
    texts = keyed.groupBy("text_key").agg(F.first("keys").alias("keys"))
    placed = index.placed(texts, "text_key")
    parts = effective_bands(index.n_hashes, index.b, index.r) * index.slots * index.files
    file = F.pmod(F.xxhash64("text_key"), F.lit(index.files))
    (
        placed.repartition(parts, "part", file)
        .write.mode("append")
        .partitionBy("part")
        .parquet(f"{index.path}/entries")
    )


def asked_entries(index: BandIndex, asked: DataFrame) -> DataFrame:
    """Entries of the parts that ``asked``, a stored table with a ``part``, names.

    Their numbers, at most one for each part there is, come to the driver, so that the scan lists and reads
    the folders of those parts only.
    """
    parts = [r.part for r in asked.select("part").distinct().collect()]
    return index.entries(asked.sparkSession).where(F.col("part").isin(parts))


def texts_sharing_bands(index: BandIndex, queries: DataFrame) -> DataFrame:
    """``(query_id, text_key)``: indexed texts that share a band with a text of ``(query_id, text)``.

    Equal texts are looked up once.
    """
    keyed = staged(index.keyed(queries, "query_id"), "query-keys")
    texts = keyed.groupBy(F.col("text_key").alias("asked_key")).agg(F.first("keys").alias("keys"))
    asked = staged(index.placed(texts, "asked_key"), "asked")
    found = (
        asked.join(asked_entries(index, asked), ["part", "key"]).select("asked_key", "text_key").distinct()
    )
    owners = keyed.select("query_id", F.col("text_key").alias("asked_key"))
    return found.join(owners, "asked_key").select("query_id", "text_key")


def similar_to_texts(
    index: BandIndex, queries: DataFrame, docs: DataFrame, threshold: float
) -> DataFrame:
    """``(query_id, doc_id, sim)``: indexed documents like given texts, which need not be indexed.

    ``sim`` is the Jaccard similarity of the shingles and reaches ``threshold``. ``docs`` has the texts of the indexed
    documents; those of copies are not read. Null and too short texts find nothing.
    """
    spark = queries.sparkSession
    found = staged(texts_sharing_bands(index, queries), "found-texts")
    wanted = index.members(spark).join(found.select("text_key").distinct(), "text_key", "left_semi")
    wanted = staged(wanted, "found-members")
    firsts = wanted.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    texts = firsts.join(docs.select("doc_id", "text"), "doc_id").select("text_key", "text")
    pairs = found.join(texts, "text_key").join(
        queries.select("query_id", F.col("text").alias("asked")), "query_id"
    )
    sim = jaccard(shingle_set(F.col("asked"), index.k), shingle_set(F.col("text"), index.k))
    close = pairs.select("query_id", "text_key", sim.alias("sim")).where(F.col("sim") >= threshold)
    return close.join(wanted, "text_key").select("query_id", "doc_id", "sim").distinct()
