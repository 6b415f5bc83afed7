"""Quality of banding: error rates, parameter sweep, parameter choice, S-curve."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import charset
from kindred.functions.charset import Side, characters
from kindred.functions.minhash import compared
from kindred.functions.text import band_probability, norm
from kindred.operators import cells
from kindred.operators.banding import (
    SHINGLE,
    band_rows,
    cut_rows,
    effective_bands,
    signatures,
)
from kindred.operators.charsets import char_sets, similar_copies, with_sets
from kindred.operators.sampling import seeded_samples
from kindred.operators.similarity import candidate_pairs, meets_often, similar_pairs, with_similarity
from kindred.operators.skew import balanced, join_counted, sums_of_pairs
from kindred.storage import staged, staged_observed

# Bands and rows per band that the parameter sweep compares.
SWEEP = ((20, 5), (20, 10), (50, 10), (50, 20), (100, 10), (200, 10))

SIMILAR = 0.85
DISSIMILAR = 0.60


# Pair counts outgrow 64 bits from some four billion documents on.
PAIR_COUNT = "decimal(38,0)"


def pairs_of(n: Column) -> Column:
    """Number of unordered pairs among n."""
    wide = n.cast("decimal(19,0)")
    return (wide * (n - 1).cast("decimal(19,0)") / 2).cast(PAIR_COUNT)


def total(count: Column) -> Column:
    """Sum of a pair count, 0 over no rows."""
    return F.coalesce(F.sum(count.cast(PAIR_COUNT)), F.lit(0)).cast(PAIR_COUNT)


def copy_pairs(signed: DataFrame) -> Column:
    """Pairs of documents with the same text, from the copy counts."""
    return signed.agg(total(pairs_of(F.col("n_copies")))).scalar()


def percent(part: Column, whole: Column) -> Column:
    """Null where the whole is 0."""
    return F.try_divide(part.cast("double") * 100, whole.cast("double"))


def document_pairs(n_x: str, n_y: str) -> Column:
    """How many document pairs two texts of so many copies stand for."""
    return F.col(n_x).cast("decimal(19,0)") * F.col(n_y).cast("decimal(19,0)")


def weighted(pairs: DataFrame, unique: DataFrame) -> DataFrame:
    """Add ``weight``: how many document pairs a pair of distinct texts stands for."""
    n_x = unique.select(F.col("doc_id").alias("x"), F.col("n_copies").alias("_nx"))
    n_y = unique.select(F.col("doc_id").alias("y"), F.col("n_copies").alias("_ny"))
    return (
        pairs.join(n_x, "x")
        .join(n_y, "y")
        .withColumn("weight", document_pairs("_nx", "_ny"))
        .drop("_nx", "_ny")
    )


def _weight_where(condition: Column) -> Column:
    return total(F.when(condition, F.col("weight")))


def pair_counts(scored: DataFrame, signed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Document-pair counts of candidates: all, above SIMILAR and below DISSIMILAR.

    ``scored`` are candidate pairs of distinct texts with ``sim`` and ``weight``;
    pairs of copies, all of similarity 1, are added from the copy counts in ``signed``.
    """
    copies = copy_pairs(signed)
    return scored.groupBy(*by).agg(
        (total(F.col("weight")) + copies).alias("n_candidates"),
        (_weight_where(F.col("sim") > SIMILAR) + copies).alias("n_over_85"),
        _weight_where(F.col("sim") < DISSIMILAR).alias("n_under_60"),
    )


def quality(counts: DataFrame) -> DataFrame:
    """Shares of candidates above 85 % and below 60 %, and whether both goals are met.

    Shares are null when there are no candidates.
    """
    over = percent(F.col("n_over_85"), F.col("n_candidates"))
    under = percent(F.col("n_under_60"), F.col("n_candidates"))
    return counts.withColumns(
        {
            "pct_over_85": over,
            "pct_under_60": under,
            "cond_1": over > 90,
            "cond_2": under < 5,
        }
    )


def candidate_counts(
    signed: DataFrame,
    sets: DataFrame,
    cuts: Sequence[tuple[int, int]],
    n_hashes: int,
    by: Sequence[str] = (),
) -> DataFrame:
    """The counts of ``pair_counts`` by character similarity, without a list of the candidates.

    Documents carry their character sets and their keys of earlier shared buckets into a bucket; a pair is
    compared in the bucket of the first band it shares, and only sums leave the task. Of a cut in which documents
    meet very often, they are compared in cells of two blocks instead, each with its keys once. ``signed`` has
    ``chars``, whose sets are in ``sets``. With ``cut`` in ``by`` there is one row per cut (bands, rows) that has candidates.
    """
    described = staged(
        with_sets(signed.select("doc_id", "n_copies", "chars", "signature"), sets)
        .drop("chars")
        .withColumn("_row", F.monotonically_increasing_id()),
        "described",
    )
    keyed = cut_rows(described.select("_row", "signature"), cuts, n_hashes).drop("keys")
    buckets = staged(
        keyed.groupBy("cut", "band", "key").agg(F.count("*").alias("n_docs")).where("n_docs > 1"), "shared-buckets"
    )
    # Only equality matters from here on, so a key is 64 bits of hash.
    in_shared = F.struct("band", F.xxhash64("band", "key").alias("key"))
    held = F.transform(F.sort_array(F.collect_list(in_shared)), lambda at: at["key"])
    rows = staged(
        join_counted(keyed, buckets, ["cut", "band", "key"], "n_docs")
        .groupBy("cut", "_row")
        .agg(held.alias("keys"))
        .join(described.drop("signature"), "_row"),
        "shared-keys",
    )
    copies = copy_pairs(signed)
    dense = _dense_cuts(buckets, rows)
    parts = [_sums_in_cells(rows.where(F.col("cut") == cut), n) for cut, n in dense.items()]
    sparse = rows.where(~F.col("cut").isin(list(dense))) if dense else rows

    def sums(a: Side, b: Side) -> list[Column]:
        weight = _weight(a, b)
        sim = charset.similarity(a, b)
        return [
            total(weight).alias("n_candidates"),
            total(F.when(sim > SIMILAR, weight)).alias("n_over_85"),
            total(F.when(sim < DISSIMILAR, weight)).alias("n_under_60"),
        ]

    if len(dense) < len(cuts):
        earlier = F.slice("keys", F.lit(1), F.col("place")).alias("earlier")
        members = sparse.select("*", F.posexplode("keys").alias("place", "key")).select(
            "cut", "key", "doc_id", "n_copies", *charset.COLUMNS, earlier
        )
        parts.append(
            sums_of_pairs(
                members,
                ["cut", "key"],
                sums,
                lambda a, b: ~F.arrays_overlap(a("earlier"), b("earlier")),
                by=["cut"],
                carry=["earlier", "n_copies", *charset.COLUMNS],
            )
        )
    return reduce(DataFrame.unionByName, parts).groupBy(*by).agg(
        (total(F.col("n_candidates")) + copies).alias("n_candidates"),
        (total(F.col("n_over_85")) + copies).alias("n_over_85"),
        total(F.col("n_under_60")).alias("n_under_60"),
    )


def _dense_cuts(buckets: DataFrame, rows: DataFrame) -> dict[str, int]:
    """Cuts whose documents meet so often that they are compared in cells, with their number of documents."""
    n = F.col("n_docs").cast("double")
    met = buckets.groupBy("cut").agg(F.sum(n * (n - 1) / 2).alias("met"))
    found = rows.groupBy("cut").agg(F.count("*").alias("n")).join(met, "cut").collect()
    return {row.cut: row.n for row in found if meets_often(row.met, row.n)}


def _sums_in_cells(rows: DataFrame, n_rows: int) -> DataFrame:
    """``(cut, n_candidates, n_over_85, n_under_60)``: partial sums over pairs that share a key, copies left out."""

    def compare(table: pa.Table, sides: cells.Sides):
        left, right = (cells.lists(table["keys"], at) for at in (sides.left, sides.right))
        sets = charset.Words(table)
        copies = table["n_copies"].to_numpy()
        sums = [0, 0, 0]
        for i, j, _ in cells.shared(left, len(sides.left), right, len(sides.right)):
            kept = cells.apart(table["doc_id"], sides, i, j)
            i, j = sides.left[i[kept]], sides.right[j[kept]]
            sim = sets.similarity(i, j)
            for k, chosen in enumerate((slice(None), sim > SIMILAR, sim < DISSIMILAR)):
                sums[k] += charset.product_sum(copies[i[chosen]], copies[j[chosen]])
        numbers = {n: pa.array([Decimal(s)], pa.decimal128(38, 0)) for n, s in zip(names, sums, strict=True)}
        yield pa.table({"cut": [table["cut"][0].as_py()], **numbers})

    names = ("n_candidates", "n_over_85", "n_under_60")
    blocks = cells.n_blocks(n_rows)
    return cells.in_cells(
        rows.select("cut", "doc_id", "n_copies", "keys", *charset.COLUMNS).where("doc_id is not null"),
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)),
        blocks,
        compare,
        "cut string, " + ", ".join(f"{name} decimal(38,0)" for name in names),
    )


def _weight(a: Side, b: Side) -> Column:
    """How many document pairs a pair stands for."""
    return a("n_copies").cast("decimal(19,0)") * b("n_copies").cast("decimal(19,0)")


def similar_set_total(sets: DataFrame) -> DataFrame:
    """One row ``n_similar``: document pairs whose character sets are over 85 % similar.

    Documents of one set are pairs too; those of different sets are summed up in cells of two blocks of sets.
    """
    between = total(F.col("between")) + copy_pairs(sets)
    return similar_copies(sets, SIMILAR).agg(between.alias("n_similar"))


def similar_char_total(docs: DataFrame) -> DataFrame:
    """The same from documents with their texts."""
    return similar_set_total(char_sets(balanced(docs, "doc_id").select(characters(F.col("text")).alias("chars"))))


def error_rates(counts: DataFrame, n_similar: Column, n_documents: Column) -> DataFrame:
    """False positives and negatives in percent of all document pairs.

    Negatives are pairs over 85 % similar that are no candidates: all similar pairs
    less those among the candidates. Positives are candidates below 60 %.
    """
    missed = n_similar - F.col("n_over_85")
    return counts.withColumns(
        {
            "n_pairs": pairs_of(n_documents),
            "n_fp": F.col("n_under_60"),
            "n_fn": missed,
            "pct_fp": percent(F.col("n_under_60"), pairs_of(n_documents)),
            "pct_fn": percent(missed, pairs_of(n_documents)),
        }
    )


def set_difference(docs: DataFrame, candidates: DataFrame, signed: DataFrame) -> DataFrame:
    """Error rates by set difference between candidates and the similarity map.

    The map holds every pair of non-empty documents, so its size follows from their
    number; candidates outside it are those with an empty document.
    """
    filled = staged(docs.where(F.length("text") > 0).select("doc_id"), "filled")
    in_both = filled.distinct().withColumn("filled", F.lit(True))
    copies = staged(signed.select("doc_id", "n_copies").join(in_both, "doc_id", "left"), "copies")
    pairs = candidates.select("x", "y")
    for side in ("x", "y"):
        pairs = pairs.join(copies.toDF(side, f"_n{side}", f"_filled_{side}"), side)
    pairs = pairs.withColumn("weight", document_pairs("_nx", "_ny"))
    n_map = pairs_of(filled.agg(F.count("*")).scalar())
    counts = pairs.agg(
        (total(F.col("weight")) + copy_pairs(copies)).alias("n_candidates"),
        (_weight_where(F.col("_filled_x") & F.col("_filled_y")) + copy_pairs(copies.where("filled"))).alias("_in_map"),
    )
    in_map = F.col("_in_map")
    return counts.withColumns(
        {"n_pairs": n_map, "n_fp": F.col("n_candidates") - in_map, "n_fn": n_map - in_map}
    ).withColumns(
        {
            "fp_rate": percent(F.col("n_fp"), F.col("n_candidates")) / 100,
            "fn_rate": percent(F.col("n_fn"), F.col("n_pairs")) / 100,
        }
    ).drop("_in_map")


def without(pairs: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs that are not among the others."""
    return pairs.join(others.select("x", "y"), ["x", "y"], "left_anti")


def sampled_error_rates(
    docs: DataFrame,
    b: int,
    r: int,
    n_hashes: int,
    sample_size: int = 100,
    n_samples: int = 10,
    k: int = SHINGLE,
) -> DataFrame:
    """Error rates over random samples of documents, one row per seed.

    Within a sample every pair counts. Similar pairs and candidates are found among
    all sampled documents at once and kept where one sample holds both.
    """
    picked = staged(seeded_samples(docs.select("doc_id"), sample_size, n_samples), "samples")
    texts = docs.join(picked.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = balanced(staged(texts, "sample-texts"), "doc_id")
    similar = similar_pairs(texts, "shingle", SIMILAR, k=k)
    keys = band_rows(signatures(texts, n_hashes, k), b, r, n_hashes)
    candidates = staged(candidate_pairs(staged(keys, "sample-bands")), "sample-candidates")
    dissimilar = with_similarity(candidates, texts, "shingle", k).where(F.col("sim") < SIMILAR)
    found = dissimilar.select("x", "y", F.lit(True).alias("is_candidate")).unionByName(
        without(similar, candidates).select("x", "y", F.lit(False).alias("is_candidate"))
    )
    with_x = picked.withColumnRenamed("doc_id", "x")
    with_y = picked.withColumnRenamed("doc_id", "y")
    wrong = (
        found.join(with_x, "x")
        .join(with_y, ["y", "seed"])
        .groupBy("seed")
        .agg(
            F.count_if("is_candidate").alias("n_fp"),
            F.count_if(~F.col("is_candidate")).alias("n_fn"),
        )
    )
    drawn = picked.groupBy("seed").agg(F.count("*").alias("n_docs"))
    return drawn.join(wrong, "seed", "left").select(
        "seed",
        "n_docs",
        F.coalesce("n_fp", F.lit(0)).alias("n_fp"),
        F.coalesce("n_fn", F.lit(0)).alias("n_fn"),
        percent(F.coalesce("n_fp", F.lit(0)), pairs_of(F.col("n_docs"))).alias("pct_fp"),
        percent(F.coalesce("n_fn", F.lit(0)), pairs_of(F.col("n_docs"))).alias("pct_fn"),
    )


def sweep(
    docs: DataFrame,
    signed: DataFrame,
    n_similar: Column,
    n_documents: Column,
    n_hashes: int,
    settings: Sequence[tuple[int, int]] = SWEEP,
    sets: DataFrame | None = None,
) -> DataFrame:
    """Quality and error rates of each (b, r) from one set of signatures.

    Settings that cut the signature alike are worked out once. The bands of all
    distinct cuts go through one join, told apart by ``cut``, which gives sums and no pairs. Texts
    of ``docs`` are read only where ``signed`` has no ``chars``.
    """
    cuts = {(b, r): (effective_bands(n_hashes, b, r), r) for b, r in settings}
    if "chars" not in signed.columns:
        signed = signed.join(docs.select("doc_id", characters(F.col("text")).alias("chars")), "doc_id")
    if sets is None:
        sets = char_sets(signed)
    counts = candidate_counts(signed, sets, sorted(set(cuts.values())), n_hashes, by=["cut"])
    copies = copy_pairs(signed)
    listed = signed.sparkSession.createDataFrame(
        [(b, r, g, f"{g}x{r}") for (b, r), (g, _) in cuts.items()],
        "b int, r int, n_bands int, cut string",
    )
    complete = (
        listed.join(counts, "cut", "left")
        .withColumn("n_candidates", F.coalesce("n_candidates", copies))
        .withColumn("n_over_85", F.coalesce("n_over_85", copies))
        .withColumn("n_under_60", F.coalesce("n_under_60", F.lit(0)))
        .drop("cut")
    )
    return error_rates(quality(complete), n_similar, n_documents)


def tuning_grid(
    levels: DataFrame,
    b_max: int,
    r_max: int,
    n_hashes: int = 200,
    target_recall: float = 0.90,
    target_false: float = 0.05,
) -> DataFrame:
    """Every (b, r) with its candidate chance at two similarity levels.

    ``levels`` has columns ``s1`` and ``s2``. A setting is feasible when it finds
    pairs of similarity s1 often enough and pairs of s2 seldom enough, and the
    signature yields that many whole bands.
    """
    grid = levels.select(
        "s1", "s2", F.explode(F.sequence(F.lit(2), F.lit(r_max))).alias("r")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(b_max))).alias("b"))
    p_s1 = band_probability(F.col("s1"), F.col("r"), F.col("b"))
    p_s2 = band_probability(F.col("s2"), F.col("r"), F.col("b"))
    fits = (n_hashes % F.col("r") == 0) & (F.col("b") * F.col("r") <= n_hashes)
    return grid.withColumns({"p_s1": p_s1, "p_s2": p_s2}).withColumn(
        "feasible",
        (F.col("p_s1") >= target_recall) & (F.col("p_s2") <= target_false) & fits,
    )


def best_setting(grid: DataFrame) -> DataFrame:
    """The grid row to use: feasible first, then recall, then few false candidates."""
    return grid.orderBy(F.desc("feasible"), F.desc("p_s1"), "p_s2", "b", "r").limit(1)


def s_curve(points: DataFrame, b: int, r: int, s: str = "s") -> DataFrame:
    """Add the candidate chance ``p`` at similarity ``s``."""
    return points.withColumn("p", band_probability(F.col(s), F.lit(r), F.lit(b)))


def s_curve_points(spark: SparkSession) -> DataFrame:
    """Similarities 0.01 to 0.99."""
    return spark.range(1, 100).select((F.col("id") / 100).alias("s"))


def pair_table(
    pairs: DataFrame, members: DataFrame, signed: DataFrame, b: int, r: int, n_hashes: int
) -> DataFrame:
    """``(x, y, jaccard, cosine, cosine_norm, is_candidate)`` of given document pairs.

    Similarities are those of the signatures. Whether a pair is a candidate is read
    from its two signatures, so no candidate list is needed, and pairs carry nothing else.
    """
    described = signed.select(
        F.col("doc_id").alias("rep_id"),
        "n_copies",
        F.size(F.array_distinct("signature")).alias("n_values"),
        "signature",
        norm(F.col("signature")).alias("norm"),
    )
    per_doc = join_counted(
        members.select("doc_id", "rep_id"), described, ["rep_id"], "n_copies"
    ).select("doc_id", F.struct("n_values", "signature", "norm").alias("d"))
    both = pairs.join(
        per_doc.select(F.col("doc_id").alias("x"), F.col("d").alias("dx")), "x"
    ).join(per_doc.select(F.col("doc_id").alias("y"), F.col("d").alias("dy")), "y")
    in_common = compared(F.col("dx.signature"), F.col("dy.signature"), r, effective_bands(n_hashes, b, r))
    n_shared = F.col("_c.n_shared")
    n_all = F.col("dx.n_values") + F.col("dy.n_values") - n_shared
    table = both.withColumn("_c", in_common).select(
        "x",
        "y",
        F.coalesce(F.try_divide(n_shared, n_all), F.lit(0.0)).alias("jaccard"),
        F.try_divide("_c.dot", F.col("dx.norm") * F.col("dy.norm")).alias("cosine"),
        F.col("_c.is_candidate").alias("is_candidate"),
    )
    cosine_column = F.col("cosine")
    stored, seen = staged_observed(
        table, "pair-table", low=F.min(cosine_column), high=F.max(cosine_column)
    )
    return normalized(stored, "cosine", "cosine_norm", seen["low"], seen["high"])


def normalized(
    rows: DataFrame, column: str, name: str, low: float | None, high: float | None
) -> DataFrame:
    """Add ``column`` scaled to 0..1 by its least and greatest value; null if it is constant."""
    ends = [F.lit(end).cast("double") for end in (low, high)]
    return rows.withColumn(name, (F.col(column) - ends[0]) / F.nullif(ends[1] - ends[0], F.lit(0.0)))
