"""Documents: latest version per id, and groups of identical texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.charset import characters
from kindred.functions.minhash import minhash_signature
from kindred.functions.text import ngrams
from kindred.operators.skew import balanced, join_counted


def latest_per_id(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key with the value that comes last in ``order``."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_key)``: a 256-bit digest stands for the text in groupings."""
    return docs.where("text is not null").select("doc_id", F.sha2("text", 256).alias("text_key"))


def copy_groups(keyed: DataFrame) -> DataFrame:
    """``(text_key, rep_id, n_copies)``: one row per distinct text.

    The least id stands for all copies. Only ids and digests are shuffled, after
    partial aggregation, so a text with very many copies costs no more than others.
    """
    return keyed.groupBy("text_key").agg(
        F.min("doc_id").alias("rep_id"), F.count("*").alias("n_copies")
    )


def hashed_texts(docs: DataFrame, n_hashes: int, k: int) -> DataFrame:
    """``(doc_id, text_key, chars, signature)`` in one pass without a shuffle.

    ``chars`` are the text's distinct characters. The signature of a text too short for a
    shingle is an empty array.
    """
    return docs.where("text is not null").select(
        "doc_id",
        F.sha2("text", 256).alias("text_key"),
        characters(F.col("text")).alias("chars"),
        minhash_signature(F.col("text"), n_hashes, k).alias("signature"),
    )


def signed_groups(hashed: DataFrame) -> DataFrame:
    """``(doc_id, n_copies, chars, signature)`` of each distinct text with a signature, by least id."""
    first = F.min(F.struct("doc_id", "chars", "signature")).alias("first")
    return (
        hashed.groupBy("text_key")
        .agg(first, F.count("*").alias("n_copies"))
        .select("first.doc_id", "n_copies", "first.chars", "first.signature")
        .where(F.size("signature") > 0)
    )


def has_repeated_ids(docs: DataFrame) -> bool:
    """Whether two rows have one id."""
    return not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def unique_documents(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """``(doc_id, text, n_copies)``, one row per distinct text, by least id.

    Copies agree in everything computed from the text, so signatures and pairs are
    worked out once per text, and counts over documents are weighted by ``n_copies``.
    The merge join keeps the texts in even parts, ready for hashing, instead of
    broadcasting them when they happen to be few.
    """
    if groups is None:
        groups = copy_groups(keyed_texts(docs))
    reps = groups.select(F.col("rep_id").alias("doc_id"), "n_copies")
    texts = balanced(docs.select("doc_id", "text"), "doc_id")
    return texts.join(reps.hint("merge"), "doc_id")


def copy_members(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """``(doc_id, rep_id, n_copies)`` for every document."""
    return join_counted(keyed, groups, ["text_key"], "n_copies").select(
        "doc_id", "rep_id", "n_copies"
    )


def shingle_rows(docs: DataFrame, k: int, drop_last: bool = False) -> DataFrame:
    """Sparse one-hot form: one row per document and distinct shingle."""
    shingles = F.array_distinct(ngrams(F.col("text"), k, drop_last))
    return docs.select("doc_id", F.explode(shingles).alias("shingle"))


def shingle_vocabulary(docs: DataFrame, k: int) -> DataFrame:
    """Distinct shingles and the number of documents that hold each."""
    return shingle_rows(docs, k).groupBy("shingle").agg(F.count("*").alias("n_docs"))
