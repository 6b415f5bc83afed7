"""Near-duplicate queries over the documents table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import charset
from kindred.functions.shingles import shingle_similarity
from kindred.functions.text import clean_text, cosine, jaccard, ngrams, norm
from kindred.operators import (
    band_index,
    banding,
    charsets,
    classes,
    documents,
    evaluation,
    sampling,
    similarity,
)
from kindred.operators.skew import balanced, join_counted
from kindred.plans.tables import documents as read_documents
from kindred.plans.tables import table
from kindred.sources import readers, writers
from kindred.storage import free_shuffles, fresh_path, staged

N_HASHES = 200
SHINGLE = 8
BANDS, ROWS = 20, 10
# Shingle length, hashes and bands for cleaned text.
CLEAN_SHINGLE = 3
CLEAN_HASHES, CLEAN_BANDS = 150, 15
# Cuts of the signature that go wrong on purpose: long rows miss similar pairs, short
# rows bring in unlike ones.
LONG_BANDS, LONG_ROWS = 10, 20
SHORT_BANDS, SHORT_ROWS = 100, 2
# Least shingle similarity of a document to a text of a few hundred characters that it may quote.
LEAST_LIKE = 0.1


@dataclass
class Signed:
    """Documents, and the stored tables made from them once.

    ``hashed`` has digest, characters and signature of every document, ``keyed`` the digest alone,
    ``groups`` a row per distinct text, and ``signed`` the signatures of those.
    """

    docs: DataFrame
    hashed: DataFrame
    keyed: DataFrame
    groups: DataFrame
    signed: DataFrame
    n_hashes: int = N_HASHES

    def texts(self) -> DataFrame:
        """The documents in even parts, for comparing texts."""
        return balanced(self.docs, "doc_id")

    def unique(self) -> DataFrame:
        return documents.unique_documents(self.docs, self.groups)

    def members(self) -> DataFrame:
        return staged(documents.copy_members(self.keyed, self.groups), "members")

    def band_rows(self, b: int = BANDS, r: int = ROWS) -> DataFrame:
        return staged(banding.band_rows(self.signed, b, r, self.n_hashes), "bands")

    def char_sets(self) -> DataFrame:
        return charsets.char_sets(self.hashed)

    def counts(self, sets: DataFrame, b: int = BANDS, r: int = ROWS) -> DataFrame:
        """Counts of the candidates of one setting by their character similarity."""
        cut = banding.effective_bands(self.n_hashes, b, r), r
        return evaluation.candidate_counts(self.signed, sets, [cut], self.n_hashes)

    def candidates(self, b: int = BANDS, r: int = ROWS) -> DataFrame:
        return staged(similarity.candidate_pairs(self.band_rows(b, r)), "candidates")

    def counted_candidates(self, b: int = BANDS, r: int = ROWS) -> DataFrame:
        """The same, not stored, with the copies of both texts; ids are not to repeat."""
        copies = self.signed.select("doc_id", "n_copies")
        return similarity.candidate_pairs(self.band_rows(b, r), copies)


def sign(docs: DataFrame, n_hashes: int = N_HASHES, k: int = SHINGLE) -> Signed:
    """Digest and signature are worked out side by side where a text is read.

    Only ids, digests and signatures are shuffled, never a text; copies are hashed each.
    """
    hashed = staged(documents.hashed_texts(balanced(docs, "doc_id"), n_hashes, k), "hashed")
    keyed = hashed.select("doc_id", "text_key")
    groups = staged(documents.copy_groups(keyed), "copy-groups")
    signed = staged(documents.signed_groups(hashed), "signatures")
    return Signed(docs, hashed, keyed, groups, signed, n_hashes)


def signed_documents(spark: SparkSession, sf_dir: str) -> Signed:
    return sign(read_documents(spark, sf_dir))


def run_lsh(docs: DataFrame, b: int, r: int) -> DataFrame:
    """Candidate pairs of ``(doc_id, text)`` rows for one setting, from text to pairs."""
    return sign(docs).candidates(b, r)


def latest_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return documents.latest_per_id(turns, "conv_id", "text", "turn")


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read back."""
    path = fresh_path(spark, "articles")
    table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("tweet_id"), "text", "lang"
    ).write.json(path)
    return readers.read_json_documents(spark, path, "bigint")


def tsv_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned benchmark texts written as a tab-separated file and read back."""
    path = fresh_path(spark, "sentences")
    table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("pair_ID"), clean_text(F.col("text")).alias("sentence_A")
    ).write.option("header", True).option("sep", "\t").csv(path)
    return readers.read_sentences(spark, path)


def tsv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts as they are, with tabs, quotes and line breaks, through a tab-separated file."""
    path = fresh_path(spark, "texts")
    texts = read_documents(spark, sf_dir).where("text <> ''")
    writers.write_quoted(
        texts.select(F.col("doc_id").alias("pair_ID"), F.col("text").alias("sentence_A")), path, sep="\t"
    )
    return readers.read_sentences(spark, path, multiline=True)


def last_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as JSON lines, in the order of turns; of each conversation the last line wins."""
    path = fresh_path(spark, "turns")
    turns = table(spark, sf_dir, "conversations").orderBy("turn", "conv_id")
    turns.select(F.col("conv_id").alias("tweet_id"), "text").write.json(path)
    lines = readers.read_json_lines(spark, path, "bigint").rows
    return documents.latest_per_id(lines, "doc_id", "text", "position")


def _damaged(lines: DataFrame) -> DataFrame:
    """The lines, some of them cut short, emptied of their id, or in place of another kind of value."""
    turn = F.col("doc_id") % 20
    damaged = (
        F.when(turn == 3, F.substring("line", 1, 15))
        .when(turn == 7, F.concat(F.lit("["), "line", F.lit("]")))
        .when(turn == 11, F.regexp_replace("line", r'^\{"tweet_id":\d+,', '{"tweet_id":"none",'))
        .when(turn == 15, F.regexp_replace("line", r'^\{"tweet_id":\d+,', "{"))
    )
    return lines.select(F.coalesce(damaged, F.col("line")).alias("value"))


def quarantined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines, some of them broken, read back: lines kept, and lines refused by reason."""
    path = fresh_path(spark, "broken-lines")
    docs = read_documents(spark, sf_dir).where("text is not null")
    named = F.struct(F.col("doc_id").alias("tweet_id"), F.substring("text", 1, 200).alias("text"))
    _damaged(docs.select("doc_id", F.to_json(named).alias("line"))).write.text(path)
    found = readers.read_json_lines(spark, path, "bigint")
    kept = found.rows.select(F.lit("kept").alias("outcome"))
    refused = found.refused.select(F.col("reason").alias("outcome"))
    return kept.unionByName(refused).groupBy("outcome").agg(F.count("*").alias("n_lines"))


def quarantined_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a condition file: lines with a field too many or too few are refused."""
    path = fresh_path(spark, "broken-conditions")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    fields = F.concat_ws(",", F.col("event_id"), F.col("user_id"), F.col("event_type"))
    short = F.concat_ws(",", F.col("event_id"), F.col("user_id"))
    turn = F.col("event_id") % 10
    line = F.when(turn == 4, short).when(turn == 8, F.concat(fields, F.lit(",more"))).otherwise(fields)
    writers.write_with_head(events.select(line.alias("value")), "ID,PATIENT,CODE", path)
    found = readers.read_checked_columns(spark, path, ["PATIENT", "CODE"])
    counted = found.rows.groupBy(F.col("CODE").alias("outcome")).agg(F.count("*").alias("n_lines"))
    return counted.unionByName(
        found.refused.groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n_lines"))
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = balanced(read_documents(spark, sf_dir), "doc_id")
    return docs.withColumn("text", clean_text(F.col("text")))


def first_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.first_rows(read_documents(spark, sf_dir), 1000)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.first_rows(read_documents(spark, sf_dir), 10)


def document_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_rows(read_documents(spark, sf_dir).select("doc_id"), 100)


def random_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_rows(read_documents(spark, sf_dir), 1)


def pair_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_pairs(table(spark, sf_dir, "documents").select("doc_id"))


def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct shingles per document: full range, last one dropped, and of cleaned text."""
    docs = balanced(read_documents(spark, sf_dir), "doc_id")
    full = F.size(F.array_distinct(ngrams(F.col("text"), SHINGLE)))
    short = F.size(F.array_distinct(ngrams(F.col("text"), SHINGLE, drop_last=True)))
    clean = F.size(F.array_distinct(ngrams(clean_text(F.col("text")), CLEAN_SHINGLE)))
    return docs.select(
        "doc_id",
        full.cast("bigint").alias("n_shingles"),
        short.cast("bigint").alias("n_without_last"),
        clean.cast("bigint").alias("n_clean"),
    )


def shingle_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.shingle_vocabulary(cleaned(spark, sf_dir), CLEAN_SHINGLE)


def copy_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = documents.keyed_texts(read_documents(spark, sf_dir))
    return documents.copy_groups(keyed).select("rep_id", "n_copies")


def copy_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text's representative and number of copies."""
    keyed = staged(documents.keyed_texts(read_documents(spark, sf_dir)), "text-keys")
    return documents.copy_members(keyed, documents.copy_groups(keyed))


def _joined_signatures(docs: DataFrame, n_hashes: int, k: int, **variant: bool) -> DataFrame:
    joined = F.array_join(F.col("signature").cast("array<string>"), ",")
    signed = banding.signatures(docs, n_hashes, k, **variant)
    return signed.select("doc_id", joined.alias("signature"))


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signature of every document, copies included, as comma-joined values."""
    docs = balanced(read_documents(spark, sf_dir), "doc_id")
    return _joined_signatures(docs, N_HASHES, SHINGLE)


def literal_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures without the last shingle; texts left without one share a sentinel's."""
    docs = balanced(read_documents(spark, sf_dir), "doc_id")
    return _joined_signatures(docs, N_HASHES, SHINGLE, drop_last=True, keep_empty=True)


def clean_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures of 150 minima over the 3-character shingles of cleaned texts."""
    return _joined_signatures(cleaned(spark, sf_dir), CLEAN_HASHES, CLEAN_SHINGLE)


def lsh_buckets(spark: SparkSession, sf_dir: str, literal: bool = False) -> DataFrame:
    """Buckets of more than one text; ``literal`` leaves the last band out."""
    signed = signed_documents(spark, sf_dir).signed
    rows = staged(banding.band_rows(signed, BANDS, ROWS, N_HASHES, literal), "bands")
    found = banding.buckets(rows)
    return found.select(
        F.col("band").cast("bigint").alias("band"), F.lower(F.hex("key")).alias("key"), "n_docs", "first_doc"
    )


def _candidates(stage: Signed, b: int) -> DataFrame:
    """Candidates with their document pairs; the list is never stored."""
    if documents.has_repeated_ids(stage.signed):
        pairs = evaluation.weighted(stage.candidates(b), stage.signed)
    else:
        pairs = stage.counted_candidates(b).withColumn("weight", evaluation.document_pairs("n_x", "n_y"))
    return pairs.withColumn("n_pairs", F.col("weight").cast("double")).select("x", "y", "n_bands", "n_pairs")


def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of distinct texts, and how many document pairs each stands for."""
    return _candidates(signed_documents(spark, sf_dir), BANDS)


def _classes(spark: SparkSession, sf_dir: str) -> tuple[Signed, DataFrame, DataFrame]:
    stage = signed_documents(spark, sf_dir)
    return stage, *classes.candidate_classes(stage.signed, BANDS, ROWS, N_HASHES)


def lsh_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of more than one document, with their texts, documents and links between texts."""
    found = _classes(spark, sf_dir)[2]
    return found.where("n_documents > 1").select("class_id", "n_texts", "n_documents", "n_links")


def lsh_class_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document that has a shingle."""
    stage, members, _ = _classes(spark, sf_dir)
    texts = members.withColumnRenamed("doc_id", "rep_id")
    counted = texts.join(stage.signed.select(F.col("doc_id").alias("rep_id"), "n_copies"), "rep_id")
    found = join_counted(stage.members().select("doc_id", "rep_id"), counted, ["rep_id"], "n_copies")
    return found.select("doc_id", "class_id")


def similar_to_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents like the benchmark texts, found through a stored index of all documents."""
    docs = read_documents(spark, sf_dir)
    index = band_index.BandIndex(fresh_path(spark, "band-index"), SHORT_BANDS, SHORT_ROWS, slots=2)
    band_index.append(index, docs)
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = band_index.similar_to_texts(index, asked, docs, LEAST_LIKE)
    return found.withColumn("sim", F.round("sim", 6))


def _clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, sf_dir).withColumn("text", clean_text(F.col("text")))


def _clean_signed(spark: SparkSession, sf_dir: str) -> Signed:
    return sign(_clean_documents(spark, sf_dir), CLEAN_HASHES, CLEAN_SHINGLE)


def clean_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for cleaned texts: 150 hashes in 15 bands of 10."""
    return _candidates(_clean_signed(spark, sf_dir), CLEAN_BANDS)


def candidate_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their similarity in all three domains and the signature cosine."""
    stage = signed_documents(spark, sf_dir)
    pairs = stage.candidates()
    paired = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    signed = stage.signed.join(paired, "doc_id", "left_semi")
    described = charsets.with_sets(signed, charsets.char_sets(signed)).join(stage.docs, "doc_id")
    described = staged(described.withColumn("norm", norm(F.col("signature"))), "paired-documents")
    columns = ["text", "signature", "norm", *charset.COLUMNS]
    scored = similarity.both_sides(pairs, described, columns)

    def x(column: str) -> Column:
        return F.col(f"of_x.{column}")

    def y(column: str) -> Column:
        return F.col(f"of_y.{column}")

    values = F.array_distinct(x("signature")), F.array_distinct(y("signature"))
    scores = {
        "sim_char": charset.similarity(x, y),
        "sim_shingle": shingle_similarity(x("text"), y("text"), SHINGLE),
        "sim_signature": jaccard(*values),
        "cosine": cosine(x("signature"), y("signature"), x("norm"), y("norm")),
    }
    return scored.select("x", "y", *[F.round(score, 6).alias(name) for name, score in scores.items()])


def jaccard_pairs(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """All pairs of distinct texts of at least 85 % similarity."""
    if domain == "signature":
        docs = signed_documents(spark, sf_dir).signed
    else:
        docs = documents.unique_documents(read_documents(spark, sf_dir))
    found = similarity.similar_pairs(docs, domain, 0.85, k=SHINGLE)
    return found.withColumn("sim", F.round("sim", 6))


def similar_documents(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """For the first hundred documents, the others that are similar.

    By characters the similarity lies between 85 % and 1, by shingles it is at least
    85 %, copies included.
    """
    stage = signed_documents(spark, sf_dir)
    found = similarity.similar_documents(
        sampling.first_rows(stage.docs.select("doc_id"), 100),
        stage.members(),
        stage.texts(),
        stage.band_rows(),
        domain=domain,
        exclude_copies=domain == "char",
        k=SHINGLE,
    )
    return found.withColumn("sim", F.round("sim", 6))


def similar_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same look-up by the shingles of cleaned texts, copies included."""
    stage = _clean_signed(spark, sf_dir)
    found = similarity.similar_documents(
        sampling.first_rows(stage.docs.select("doc_id"), 100),
        stage.members(),
        stage.texts(),
        stage.band_rows(CLEAN_BANDS),
        domain="shingle",
        exclude_copies=False,
        k=CLEAN_SHINGLE,
    )
    return found.withColumn("sim", F.round("sim", 6))


def _as_doubles(counts: DataFrame) -> DataFrame:
    """Pair counts as doubles, rates rounded."""
    columns = []
    for name, kind in counts.dtypes:
        if kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        elif kind == "double":
            columns.append(F.round(name, 6).alias(name))
        else:
            columns.append(F.col(name))
    return counts.select(*columns)


def lsh_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = signed_documents(spark, sf_dir)
    return _as_doubles(evaluation.quality(stage.counts(charsets.char_sets(stage.signed))))


def _similar_total(sets: DataFrame) -> Column:
    return staged(evaluation.similar_set_total(sets), "similar-total").scalar()


def lsh_fp_fn(
    spark: SparkSession, sf_dir: str, b: int = BANDS, r: int = ROWS
) -> DataFrame:
    stage = signed_documents(spark, sf_dir)
    sets = stage.char_sets()
    n_documents = stage.docs.agg(F.count("*")).scalar()
    return _as_doubles(
        evaluation.error_rates(stage.counts(sets, b, r), _similar_total(sets), n_documents)
    )


def lsh_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = signed_documents(spark, sf_dir)
    sets = stage.char_sets()
    n_documents = stage.docs.agg(F.count("*")).scalar()
    return _as_doubles(
        evaluation.sweep(
            stage.docs, stage.signed, _similar_total(sets), n_documents, N_HASHES, sets=sets
        )
    )


def lsh_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = signed_documents(spark, sf_dir)
    return _as_doubles(
        evaluation.set_difference(stage.docs, stage.candidates(), stage.signed)
    )


def lsh_missed_pairs(
    spark: SparkSession, sf_dir: str, b: int = BANDS, r: int = ROWS
) -> DataFrame:
    """Pairs similar by shingles that banding does not find."""
    similar = _similar_by_shingles(spark, sf_dir)
    return evaluation.without(similar, signed_documents(spark, sf_dir).candidates(b, r))


def lsh_false_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that are not similar by shingles."""
    similar = _similar_by_shingles(spark, sf_dir)
    return evaluation.without(signed_documents(spark, sf_dir).candidates(), similar).select("x", "y")


def _similar_by_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pairs of distinct texts similar by shingles; found before any text is signed, so that less is on disk at once."""
    docs = documents.unique_documents(read_documents(spark, sf_dir))
    found = staged(similarity.similar_pairs(docs, "shingle", 0.85, k=SHINGLE).select("x", "y"), "similar")
    free_shuffles(spark)
    return found


def lsh_sampled_fp_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rates averaged over ten samples of a hundred documents."""
    docs = read_documents(spark, sf_dir)
    return _mean_rates(evaluation.sampled_error_rates(docs, BANDS, ROWS, N_HASHES, k=SHINGLE))


def clean_sampled_fp_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for cleaned texts: 150 hashes in 15 bands of 10."""
    docs = _clean_documents(spark, sf_dir)
    return _mean_rates(
        evaluation.sampled_error_rates(docs, CLEAN_BANDS, ROWS, CLEAN_HASHES, k=CLEAN_SHINGLE)
    )


def _mean_rates(rates: DataFrame) -> DataFrame:
    return rates.agg(
        F.count("*").alias("n_samples"),
        F.sum("n_fp").alias("n_fp"),
        F.sum("n_fn").alias("n_fn"),
        F.round(F.avg("pct_fp"), 6).alias("pct_fp"),
        F.round(F.avg("pct_fn"), 6).alias("pct_fn"),
    )


def _scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = signed_documents(spark, sf_dir)
    long_enough = stage.signed.join(
        stage.groups.select("text_key", F.col("rep_id").alias("doc_id")), "doc_id"
    ).select("text_key", F.col("doc_id").alias("rep_id"), "n_copies")
    members = staged(documents.copy_members(stage.keyed, long_enough), "members")
    pairs = sampling.random_pairs(members.select("doc_id"))
    return evaluation.pair_table(pairs, members, stage.signed, BANDS, ROWS, N_HASHES)


def pair_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random document pairs with signature similarities and whether they are candidates."""
    points = _scatter(spark, sf_dir)
    names = ("jaccard", "cosine", "cosine_norm")
    return points.select(
        "x", "y", "is_candidate", *[F.round(name, 6).alias(name) for name in names]
    )


def s_curve_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per step of signature similarity: random pairs, candidates among them, S-curve."""
    steps = (
        _scatter(spark, sf_dir)
        .groupBy(F.floor(F.col("jaccard") * 20 + F.lit(1e-9)).cast("bigint").alias("step"))
        .agg(F.count("*").alias("n_pairs"), F.count_if("is_candidate").alias("n_candidates"))
        .withColumn("s", F.col("step") / 20)
    )
    curve = evaluation.s_curve(steps, BANDS, ROWS)
    return curve.select("step", "n_pairs", "n_candidates", F.round("p", 6).alias("p"))


def lsh_tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuning grid for the similarity levels met among the candidates.

    The upper level is the mean shingle similarity of the candidate document pairs of at
    least 85 %, pairs of copies included, the lower one that of all others.
    """
    stage = signed_documents(spark, sf_dir)
    pairs = similarity.with_similarity(stage.candidates(), stage.texts(), "shingle", SHINGLE)
    sim, weight = F.col("sim"), F.col("weight").cast("double")
    copies = evaluation.copy_pairs(stage.signed).cast("double")

    def mean(rows: Column, more: Column) -> Column:
        total = [F.coalesce(F.sum(F.when(rows, c)), F.lit(0.0)) + more for c in (weight * sim, weight)]
        return F.round(F.try_divide(*total), 4)

    levels = evaluation.weighted(pairs, stage.signed).agg(
        mean(sim >= 0.85, copies).alias("s1"), mean(sim < 0.85, F.lit(0.0)).alias("s2")
    )
    grid = evaluation.tuning_grid(staged(levels, "levels"), 50, 50, N_HASHES)
    best = evaluation.best_setting(grid).select("b", "r", F.lit(True).alias("is_best"))
    return grid.join(best, ["b", "r"], "left").select(
        "s1",
        "s2",
        "b",
        "r",
        F.round("p_s1", 6).alias("p_s1"),
        F.round("p_s2", 6).alias("p_s2"),
        "feasible",
        F.coalesce("is_best", F.lit(False)).alias("is_best"),
    )
