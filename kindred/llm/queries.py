"""One registered query per operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    decontamination,
    fill_middle,
    fingerprints,
    jaccard_join,
    language,
    license_scan,
    mixing,
    quality,
    token_align,
    token_counts,
    toxicity,
    url_filter,
    warc,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read(spark, sf_dir, "documents"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judged(pages).drop("url")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment(read(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = fill_middle.fill_in_middle(read(spark, sf_dir, "documents"))
    back = fill_middle.restored(turned.withColumn("output_sha256", F.sha2("output", 256)))
    return back.withColumn("restored_sha256", F.sha2("text", 256)).drop("text")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality": op3_quality,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_fingerprints": op7_fingerprints,
    "op8_license_scan": op8_license_scan,
    "op9_language": op9_language,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_url_filter": op11_url_filter,
    "op12_token_alignment": op12_token_alignment,
    "op13_fill_middle": op13_fill_middle,
}
