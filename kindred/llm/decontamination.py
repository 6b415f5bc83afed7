"""Benchmark decontamination: prefix-filtered containment of item windows in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.storage import staged

# Separators of words once A-Z have become a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 13
SHINGLE = 3
WINDOW_KEY = ["item", "item_key", "first"]


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z and nothing else changes; ASCII texts take the shorter way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _shingle_hashes(words: str, width: int) -> Column:
    """64-bit hash of each run of ``width`` words, in order."""
    runs = F.slice(words, F.lit(1), F.greatest(F.size(words) - F.lit(width - 1), F.lit(0)))
    return F.transform(
        runs, lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + k) for k in range(1, width)])
    )


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per window of an item: its first word, its length and its shingle hashes.

    An item of fewer words, but not none, is one window; windows of fewer than
    ``shingle`` words are one shingle as wide as they are.
    """
    cut = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.xxhash64("text").alias("item_key"),
        words_of(F.col("text")).alias("words"),
    ).where(F.size("words") > 0).distinct()
    width = F.least(F.size("words"), F.lit(shingle))
    by_width = [F.when(width == w, _shingle_hashes("words", w)) for w in range(1, shingle + 1)]
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("words") - length)
    opened = cut.select(
        "*", width.alias("width"), length.alias("length"), F.coalesce(*by_width).alias("hashes")
    ).select("*", F.explode(starts).alias("first"))
    return opened.select(
        "item",
        "item_key",
        "first",
        "length",
        "width",
        F.slice("hashes", F.col("first") + 1, F.col("length") - F.col("width") + 1).alias("hashes"),
    )


def matched_shingles(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``(doc_id, doc_key, n_words, pos, width, hash)``: shingles of documents that an item has.

    One pass over the texts. The first row of each document is kept even where nothing
    matches (``hash`` null), so that the result holds every document. The
    vocabulary of the items is stored first: the planner broadcasts it if its stored
    size allows that, and otherwise shuffles both sides, splitting frequent shingles.
    """
    vocabulary = staged(
        windows.select(F.explode("hashes").alias("hash"), "width").distinct(), "item-shingles"
    )
    widths = sorted(row.width for row in vocabulary.select("width").distinct().collect())
    cut = docs.select(
        "doc_id", F.xxhash64("text").alias("doc_key"), words_of(F.col("text")).alias("words")
    )
    found = None
    for width in widths or [SHINGLE]:
        tokens = cut.select(
            "doc_id",
            "doc_key",
            F.coalesce(F.size("words"), F.lit(0)).alias("n_words"),
            _shingle_hashes("words", width).alias("hashes"),
        ).select("doc_id", "doc_key", "n_words", F.posexplode_outer("hashes").alias("pos", "_hash"))
        of_width = vocabulary.where(F.col("width") == width).select("hash")
        met = tokens.join(of_width, F.col("_hash") == F.col("hash"), "left")
        leads = F.coalesce(F.col("pos"), F.lit(0)) == 0
        if found is not None:
            leads = F.lit(False)
        met = met.where(F.col("hash").isNotNull() | leads).select(
            "doc_id",
            "doc_key",
            "n_words",
            F.coalesce("pos", F.lit(0)).alias("pos"),
            F.lit(width).alias("width"),
            "hash",
            leads.alias("leads"),
        )
        found = met if found is None else found.unionByName(met)
    return found


def _same_document(a: str = "doc_id", b: str = "_doc_id") -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & F.col("doc_key").eqNullSafe(F.col("_doc_key"))


def occurrences(matches: DataFrame, windows: DataFrame) -> DataFrame:
    """``(doc_id, doc_key, item, start, length)``: places where a whole window occurs.

    A window is contained only if its rarest shingle is, so that one shingle is the prefix
    that must be joined; rarity is the number of occurrences in all documents. The
    place of the shingle gives the only start the window can have, which must leave room for
    the window's length. Candidates then look up each of their shingles at its place.
    Windows with a shingle that no document has drop out at once.
    """
    places = matches.where("hash is not null").select(
        "doc_id", "doc_key", "n_words", "pos", "width", "hash"
    ).distinct()
    counts = places.groupBy("hash", "width").agg(F.count("*").alias("df"))
    opened = windows.select(
        *WINDOW_KEY, "width", F.size("hashes").alias("needed"), F.posexplode("hashes").alias("offset", "hash")
    )
    rarest = (
        opened.join(counts, ["hash", "width"])
        .groupBy(*WINDOW_KEY, "needed")
        .agg(
            F.count("*").alias("present"),
            F.min(F.struct("df", "hash", "offset")).alias("prefix"),
        )
        .where("present = needed")
        .select(
            *[F.col(c).alias(f"_{c}") for c in WINDOW_KEY],
            F.col("prefix.hash").alias("prefix_hash"),
            F.col("prefix.offset").alias("prefix_offset"),
        )
    )
    same = [windows[c] == F.col(f"_{c}") for c in WINDOW_KEY]
    prefixes = staged(
        windows.join(rarest, same).select(
            *WINDOW_KEY, "length", F.col("width").alias("_width"), "hashes", "prefix_hash", "prefix_offset"
        ),
        "window-prefixes",
    )
    start = F.col("pos") - F.col("prefix_offset")
    candidates = (
        places.join(
            prefixes,
            (F.col("hash") == F.col("prefix_hash")) & (F.col("width") == F.col("_width")),
        )
        .withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    )
    expected = candidates.select(
        F.col("doc_id").alias("_doc_id"),
        F.col("doc_key").alias("_doc_key"),
        *WINDOW_KEY,
        "start",
        "length",
        "_width",
        F.size("hashes").alias("needed"),
        F.posexplode("hashes").alias("_offset", "_hash"),
    )
    there = (
        _same_document()
        & (F.col("pos") == F.col("start") + F.col("_offset"))
        & (F.col("hash") == F.col("_hash"))
        & (F.col("width") == F.col("_width"))
    )
    return (
        expected.join(places, there)
        .groupBy("_doc_id", "_doc_key", *WINDOW_KEY, "start", "length", "needed")
        .agg(F.count("*").alias("present"))
        .where("present = needed")
        .select(
            F.col("_doc_id").alias("doc_id"),
            F.col("_doc_key").alias("doc_key"),
            "item",
            "start",
            "length",
        )
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, contaminated)`` for every document.

    ``n_hit`` counts the words inside any occurrence of a window of an item, ``items`` is
    the sorted array of ids of items with such a window. A document is contaminated
    if it has a hit and its hits are at least a twentieth of its words. A shingle
    is stood for by a 64-bit hash.

    Null and empty texts have no words and no hits. Null document ids stay null; a null
    item id is the item of the empty name; items without words are never found. Repeated
    rows give repeated results. Without documents there are no rows, without items
    no hits. Other columns are ignored.
    """
    windows = staged(item_windows(items, window, shingle), "windows")
    matches = staged(matched_shingles(docs, windows), "matches")
    found = occurrences(matches, windows)
    end = F.col("start") + F.col("length")
    by_start = Window.partitionBy("doc_id", "doc_key").orderBy("start", "length", "item")
    covered = F.max(end).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(covered, F.lit(0))))
    hits = (
        found.withColumn("fresh", fresh)
        .groupBy("doc_id", "doc_key")
        .agg(F.sum("fresh").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("doc_key").alias("_doc_key"), "n_hit", "items")
    )
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    every = matches.where("leads").select("doc_id", "doc_key", F.col("n_words").cast("long"))
    return every.join(hits, _same_document(), "left").select(
        "doc_id",
        "doc_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, items).where("contaminated").select(
        F.col("doc_id").alias("_doc_id"), F.col("doc_key").alias("_doc_key")
    ).distinct()
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text_key") == F.col("_doc_key"))
    return keyed.join(bad, same, "left_anti").drop("_text_key")
