"""Signatures, bands and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.minhash import minhash_signature

N_HASHES = 200
SHINGLE = 8


def effective_bands(n_hashes: int, b: int, r: int, literal: bool = False) -> int:
    """Bands of r values that a signature yields, at most b.

    ``literal`` leaves the last of b bands out, as one of the scripts followed does.
    """
    if n_hashes % r:
        raise ValueError(f"{n_hashes} hashes do not divide into bands of {r}")
    return min(b - 1 if literal else b, n_hashes // r)


def signatures(
    docs: DataFrame,
    n_hashes: int = N_HASHES,
    k: int = SHINGLE,
    drop_last: bool = False,
    keep_empty: bool = False,
) -> DataFrame:
    """``docs`` without its text and with a MinHash ``signature``.

    Documents too short for a shingle are left out, or with ``keep_empty`` share
    the signature of one sentinel.
    """
    others = [c for c in docs.columns if c != "text"]
    kept = docs.where("text is not null")
    if not keep_empty:
        kept = kept.where(F.length("text") >= (k + 1 if drop_last else k))
    signature = minhash_signature(F.col("text"), n_hashes, k, drop_last, keep_empty)
    return kept.select(*others, signature.alias("signature"))


def band_key(band: Column, r: Column | int, compact: bool = True) -> Column:
    """Key of a band: its r values joined by commas, or the 16 bytes of their md5."""
    values = F.slice("signature", (band * r + 1).cast("int"), F.lit(r))
    key = F.array_join(values.cast("array<string>"), ",")
    return F.unhex(F.md5(key)) if compact else key


def band_keys(n_hashes: int, b: int, r: int, literal: bool = False) -> Column:
    """Array of the keys of all bands."""
    last = F.lit(effective_bands(n_hashes, b, r, literal) - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda band: band_key(band, r))


def band_rows(
    signed: DataFrame,
    b: int,
    r: int,
    n_hashes: int = N_HASHES,
    literal: bool = False,
    compact: bool = True,
) -> DataFrame:
    """``(doc_id, band, key)``: one row per document and band."""
    last = F.lit(effective_bands(n_hashes, b, r, literal) - 1)
    return signed.select(
        "doc_id", "signature", F.explode(F.sequence(F.lit(0), last)).alias("band")
    ).select("doc_id", "band", band_key(F.col("band"), r, compact).alias("key"))


def cut_rows(
    signed: DataFrame, cuts: Sequence[tuple[int, int]], n_hashes: int = N_HASHES
) -> DataFrame:
    """``signed`` without its signature, one row per document, cut and band.

    ``cuts`` are (bands, rows). ``cut`` names them as in ``20x10``; ``keys`` are the keys of all bands of
    the cut, ``key`` that of the row's ``band``.
    """
    others = [c for c in signed.columns if c != "signature"]
    each = [
        F.struct(F.lit(f"{g}x{r}").alias("cut"), band_keys(n_hashes, g, r).alias("keys")) for g, r in cuts
    ]
    return signed.select(*others, F.inline(F.array(*each))).select(
        "*", F.posexplode("keys").alias("band", "key")
    )


def is_first_shared(band: Column, keys_x: Column, keys_y: Column) -> Column:
    """Whether two documents that share a band share no earlier one."""
    return ~shares_band(*[F.slice(keys, F.lit(1), band) for keys in (keys_x, keys_y)])


def shares_band(keys_x: Column, keys_y: Column) -> Column:
    """Whether two documents' key arrays agree in any band."""
    return F.exists(F.zip_with(keys_x, keys_y, lambda p, q: p == q), lambda same: same)


def buckets(rows: DataFrame) -> DataFrame:
    """Size and least id of every bucket with more than one document."""
    return (
        rows.groupBy("band", "key")
        .agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
        .where("n_docs > 1")
    )
