"""Candidate pairs, similarity of pairs, and similar-document lookup."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import charset
from kindred.functions.shingles import distinct_hashes, shingle_hashes, shingle_similarity, similarities
from kindred.functions.text import char_set, cosine, jaccard, norm, shingle_set
from kindred.operators import cells, charsets, prefixes
from kindred.operators.banding import SHINGLE
from kindred.operators.documents import has_repeated_ids
from kindred.operators.skew import join_counted, pairs_sharing_key
from kindred.storage import staged

# Meetings for each row and cell it goes to, from which on rows are compared in cells of two blocks.
DENSE = 16
# Texts of a block whose pairs are looked at together.
CELL_TEXTS = 128
# Where ids repeat: ranges of token hashes that are counted to put tokens in order, and first tokens of a set beyond those needed to share one.
RANGES = 1 << 20
MORE_TOKENS = 0.03


def meets_often(meetings: int, n_rows: int) -> bool:
    """Whether so many meetings of so many rows cost more one by one than in cells of blocks.

    The number for each row and block depends on how alike the rows are, not on how many they are.
    """
    return meetings > DENSE * n_rows * cells.n_blocks(n_rows)


def candidate_pairs(rows: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """``(x, y, n_bands)``: pairs that share a bucket, and in how many bands.

    ``rows`` are ``(doc_id, band, key)`` of distinct texts; copies of a text share
    every bucket and are counted through their group instead of being paired. Where buckets are so large
    that many pairs meet often, documents are compared in cells of two blocks, and no meeting and no pair is shuffled.
    ``copies`` with ``(doc_id, n_copies)``, each id once, adds ``n_x`` and ``n_y``.
    """
    groups = staged(
        rows.groupBy("band", "key").agg(F.count("*").alias("n_docs")).where("n_docs > 1"), "shared-buckets"
    )
    n = F.col("n_docs").cast("double")
    meetings = groups.agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))).first()[0]
    if meetings:
        in_shared = join_counted(rows, groups, ["band", "key"], "n_docs").where("doc_id is not null")
        # Only equality matters from here on, so a key is 64 bits of hash.
        docs = staged(
            in_shared.groupBy("doc_id").agg(F.collect_list(F.xxhash64("band", "key")).alias("keys")), "shared-keys"
        )
        n_docs = docs.count()
        if meets_often(meetings, n_docs):
            return _pairs_in_cells(docs, n_docs, copies)
    pairs = pairs_sharing_key(rows, ["band", "key"]).withColumnRenamed("n_shared", "n_bands")
    if copies is not None:
        for side in ("x", "y"):
            pairs = pairs.join(copies.toDF(side, f"n_{side}"), side)
    return pairs


def _pairs_in_cells(docs: DataFrame, n_docs: int, copies: DataFrame | None) -> DataFrame:
    with_copies = copies is not None
    if with_copies:
        docs = docs.join(copies, "doc_id")

    def compare(table: pa.Table, sides: cells.Sides):
        ids = table["doc_id"].to_numpy()
        left, right = (cells.lists(table["keys"], rows) for rows in (sides.left, sides.right))
        for i, j, n in cells.shared(left, len(sides.left), right, len(sides.right)):
            kept = cells.apart(table["doc_id"], sides, i, j)
            i, j, n = sides.left[i[kept]], sides.right[j[kept]], n[kept]
            swap = ids[i] > ids[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            found = {"x": ids[i], "y": ids[j], "n_bands": n.astype(np.int64)}
            if with_copies:
                held = table["n_copies"].to_numpy()
                found |= {"n_x": held[i], "n_y": held[j]}
            yield pa.table(found)

    blocks = cells.n_blocks(n_docs)
    schema = "x long, y long, n_bands long" + (", n_x long, n_y long" if with_copies else "")
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    return cells.in_cells(docs, block, blocks, compare, schema)


def token_set(domain: str, k: int = SHINGLE, text: str = "text") -> Column:
    """The set a document is compared by: ``char``, ``shingle`` or ``signature``."""
    if domain == "char":
        return char_set(F.col(text))
    if domain == "shingle":
        return shingle_set(F.col(text), k)
    if domain == "signature":
        return F.array_distinct(text)
    raise ValueError(f"unknown domain: {domain}")


def source_column(domain: str) -> str:
    return "signature" if domain == "signature" else "text"


def _with_column_of_both(pairs: DataFrame, docs: DataFrame, column: str) -> DataFrame:
    one = docs.select(F.col("doc_id").alias("x"), F.col(column).alias("_of_x"))
    other = docs.select(F.col("doc_id").alias("y"), F.col(column).alias("_of_y"))
    return pairs.join(one, "x").join(other, "y")


def both_sides(pairs: DataFrame, docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add structs ``of_x`` and ``of_y`` of the given columns of both documents of a pair.

    For pairs compared in several ways: each side is fetched once.
    """
    for side in ("x", "y"):
        held = docs.select(F.col("doc_id").alias(side), F.struct(*columns).alias(f"of_{side}"))
        pairs = pairs.join(held, side)
    return pairs


def with_similarity(
    pairs: DataFrame, docs: DataFrame, domain: str, k: int = SHINGLE, name: str = "sim"
) -> DataFrame:
    """Add the Jaccard similarity of each pair.

    Texts are joined and cut up afterwards: a shingle set is many times larger than
    its text, and documents without a pair are not cut up at all.
    """
    both = _with_column_of_both(pairs, docs, source_column(domain))
    if domain == "shingle":
        sim = shingle_similarity(F.col("_of_x"), F.col("_of_y"), k)
    else:
        sim = jaccard(token_set(domain, k, "_of_x"), token_set(domain, k, "_of_y"))
    return both.withColumn(name, sim).drop("_of_x", "_of_y")


def with_cosine(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Add the cosine of the signatures of each pair."""
    both = _with_column_of_both(pairs, signed, "signature")
    a, b = F.col("_of_x"), F.col("_of_y")
    return both.withColumn("cosine", cosine(a, b, norm(a), norm(b))).drop("_of_x", "_of_y")


def _least_overlap(size: Column, threshold: float) -> Column:
    """The fewest tokens a set of this size shares with any set that similar to it."""
    return F.ceil(size * F.lit(threshold) - F.lit(1e-9)).cast("int")


def _range_counts(hashed: DataFrame) -> np.ndarray:
    """How many hashes of all sets fall into each of a fixed number of ranges."""

    def counted(batches):
        n = np.zeros(RANGES, np.int64)
        for batch in batches:
            n += np.bincount(range_of(batch["hashes"].flatten().to_numpy(zero_copy_only=False)), minlength=RANGES)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"range": at, "n": n[at]})

    ranges = hashed.select("hashes").mapInArrow(counted, "range long, n long").groupBy("range").agg(F.sum("n").alias("n"))
    found = ranges.toArrow()
    counts = np.zeros(RANGES, np.int64)
    counts[found["range"].to_numpy()] = found["n"].to_numpy()
    return counts


def range_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & (RANGES - 1)).astype(np.int64)


def _rarest_first(hashed: DataFrame, threshold: float) -> DataFrame:
    """``(doc_id, size, first)``: of each set, its first tokens, the rarest first.

    The order is that of the count of a token's range, then of the token: the same in all sets.
    """
    counts = hashed.sparkSession.sparkContext.broadcast(_range_counts(hashed))

    def ordered(batches):
        for batch in batches:
            column = batch["hashes"]
            sizes, first = [], []
            for row in column:
                tokens = row.values.to_numpy(zero_copy_only=False)
                order = np.lexsort((tokens, counts.value[range_of(tokens)]))
                least = int(np.ceil(len(tokens) * threshold - 1e-9))
                sizes.append(len(tokens))
                more = int(len(tokens) * MORE_TOKENS)
                first.append(tokens[order[: len(tokens) - least + 1 + more]])
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in first], dtype=np.int64)])
            values = np.concatenate([*first, np.empty(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "size": pa.array(sizes, pa.int32()), "first": lists})

    kind = dict(hashed.dtypes)["doc_id"]
    return hashed.mapInArrow(ordered, f"doc_id {kind}, size int, first array<long>")


def _similar_by_id(docs: DataFrame, domain: str, threshold: float, strict: bool, k: int) -> DataFrame:
    """``similar_pairs`` where ids repeat or are no numbers: the tokens of an id's rows are one list, first tokens are rows."""
    if domain == "shingle":
        sets = docs
        hashes = shingle_hashes(F.col("text"), k)
    else:
        token_array = token_set(domain, k, source_column(domain))
        sets = staged(docs.select("doc_id", token_array.alias("tokens")), "sets")
        hashes = F.array_distinct(F.transform("tokens", lambda token: F.xxhash64(token)))
    hashed = sets.select("doc_id", hashes.alias("hashes")).where(F.size("hashes") > 0)
    hashed = hashed.groupBy("doc_id").agg(F.flatten(F.collect_list("hashes")).alias("hashes"))
    ranked = _rarest_first(hashed, threshold)
    prefixes = ranked.select("doc_id", "size", F.posexplode("first").alias("place", "token"))

    def must_share(a, b) -> Column:
        return 1 + F.floor(F.least(a("size"), b("size")) * F.lit(MORE_TOKENS)).cast("int")

    def can_be_similar(a, b) -> Column:
        # Where two similar sets meet for one of the first so many times, the tokens still to come must suffice.
        still = F.least(a("size") - a("place"), b("size") - b("place"))
        overlap = _least_overlap(a("size") + b("size"), threshold / (1 + threshold))
        return still >= overlap - must_share(a, b) + 1

    close = pairs_sharing_key(
        staged(prefixes, "prefixes"),
        ["token"],
        carry=["size", "place"],
        keep=can_be_similar,
        needed=must_share,
    ).select("x", "y")
    if domain == "shingle":
        scored = with_similarity(staged(close, "close"), docs, domain, k)
    else:
        both = _with_column_of_both(close, sets, "tokens")
        scored = both.select(
            "x", "y", jaccard(F.col("_of_x"), F.col("_of_y")).alias("sim")
        )
    enough = F.col("sim") > threshold if strict else F.col("sim") >= threshold
    return scored.where(enough)


def similar_pairs(
    docs: DataFrame, domain: str, threshold: float, strict: bool = False, k: int = SHINGLE
) -> DataFrame:
    """All pairs of documents whose Jaccard similarity reaches ``threshold``.

    Returns ``(x, y, sim)``; exact, without comparing all pairs: only sets that share several of their rarest
    tokens, and whose sizes are close enough, are compared (``prefixes.close_pairs``). Tokens are 64-bit hashes
    there: a collision can only add a comparison, as the similarity itself
    comes from the tokens. Only the first tokens of a set are shuffled, and the texts to be compared, once for each cell of like
    texts. ``docs`` hold distinct texts, or distinct token sets; those of repeated ids go another way.

    Characters are few and most sets share nearly all of them, so that no rare token tells sets apart: there
    they are compared as bits, in cells of two blocks of sets of like size, and no pair is shuffled.
    """
    if domain == "char":
        rows = staged(docs.select("doc_id", charset.characters(F.col("text")).alias("chars")), "characters")
        found = charsets.similar_rows(rows.where("chars <> ''"), charsets.char_sets(rows), threshold)
        return found.where(F.col("sim") > threshold) if strict else found
    if dict(docs.dtypes)["doc_id"] != "bigint" or has_repeated_ids(docs):
        return _similar_by_id(docs, domain, threshold, strict, k)
    docs = docs.where("doc_id is not null")
    if domain == "shingle":
        texts = docs.select("doc_id", "text")
        close = staged(prefixes.close_pairs(texts, lambda batch: shingles_of(batch, k), threshold), "close")

        def compare(held: pa.Table, asked: pa.Table) -> pa.Table:
            at = dict(zip(held["doc_id"].to_pylist(), held["text"].to_pylist(), strict=True))
            asked = asked.select(["x", "y"]).sort_by([("x", "ascending"), ("y", "ascending")])
            x, y = (asked[side].to_pylist() for side in ("x", "y"))
            sims = similarities(((at[a] or "", at[b] or "") for a, b in zip(x, y, strict=True)), k)
            return asked.append_column("sim", pa.array(sims, pa.float64())).filter(pa.array(np.array(sims) >= threshold))

        scored = prefixes.in_shared_cells(close, texts, ["text"], CELL_TEXTS, compare, "y long, x long, sim double")
    else:
        token_array = token_set(domain, k, source_column(domain))
        sets = staged(docs.select("doc_id", token_array.alias("tokens")), "sets")
        hashes = F.array_sort(F.array_distinct(F.transform("tokens", lambda token: F.xxhash64(token))))
        hashed = sets.select("doc_id", hashes.alias("hashes")).where(F.size("hashes") > 0)
        close = staged(prefixes.close_pairs(hashed, listed, threshold), "close")
        both = _with_column_of_both(close, sets, "tokens")
        scored = both.select(
            "x", "y", jaccard(F.col("_of_x"), F.col("_of_y")).alias("sim")
        )
    enough = F.col("sim") > threshold if strict else F.col("sim") >= threshold
    return scored.where(enough)


def shingles_of(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    """Hashes of the distinct shingles of each text of a batch; none of a null text."""
    return (distinct_hashes(text.as_py() or "", k) for text in batch.column("text"))


def listed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return (row.values.to_numpy(zero_copy_only=False) for row in batch.column("hashes"))


def partners(queries: DataFrame, rows: DataFrame) -> DataFrame:
    """``(doc_id, partner)``: documents that share a bucket with a query document.

    Only buckets of the queries are looked at, so the full pair list is not needed.
    """
    asked = queries.select("doc_id").distinct()
    wanted = rows.join(asked, "doc_id", "left_semi").select(
        "band", "key", F.col("doc_id").alias("_query")
    )
    return (
        wanted.join(rows, ["band", "key"])
        .where(F.col("_query") != F.col("doc_id"))
        .select(F.col("_query").alias("doc_id"), F.col("doc_id").alias("partner"))
        .distinct()
    )


def similar_documents(
    queries: DataFrame,
    members: DataFrame,
    texts: DataFrame,
    rows: DataFrame,
    domain: str = "char",
    threshold: float = 0.85,
    exclude_copies: bool = True,
    k: int = SHINGLE,
) -> DataFrame:
    """``(doc_id, other_id, sim)`` for each query document.

    With ``exclude_copies`` the similarity must lie strictly between the threshold
    and 1; otherwise it must reach the threshold, and copies of the query count as
    similar. ``members`` maps documents to their text's representative; ``texts``
    and ``rows`` hold one entry per distinct text.
    """
    asked = members.join(queries.select("doc_id").distinct(), "doc_id", "left_semi").select(
        F.col("doc_id").alias("_query"), F.col("rep_id").alias("doc_id")
    )
    found = partners(asked, rows).select(
        F.least("doc_id", "partner").alias("x"),
        F.greatest("doc_id", "partner").alias("y"),
        "doc_id",
        "partner",
    )
    scored = with_similarity(found, texts, domain, k)
    if exclude_copies:
        scored = scored.where((F.col("sim") > threshold) & (F.col("sim") < 1))
    else:
        scored = scored.where(F.col("sim") >= threshold)
    scored = scored.select("doc_id", F.col("partner").alias("rep_id"), "sim")
    if not exclude_copies:
        own = asked.select("doc_id").distinct().join(rows, "doc_id", "left_semi")
        scored = scored.unionByName(
            own.select("doc_id", F.col("doc_id").alias("rep_id"), F.lit(1.0).alias("sim"))
        )
    return (
        asked.join(scored, "doc_id")
        .join(members.select(F.col("doc_id").alias("other_id"), "rep_id"), "rep_id")
        .where(F.col("_query") != F.col("other_id"))
        .select(F.col("_query").alias("doc_id"), "other_id", "sim")
    )
