"""File scans with fixed schemas."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.storage import fresh_path

ITEM_SEPARATOR = ", "


def read_csv_columns(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", multiline: bool = False
) -> DataFrame:
    """Named columns of a delimited file with a header row, all as strings.

    Columns are found by header name, so the file may hold others. All files under the path
    must have the same header; one that differs stops the job instead of giving wrong
    columns. Compressed files are read as they are. ``multiline`` admits quoted line breaks, at the
    price of one task per file.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .csv(path)
        .select(*columns)
    )


class Checked(NamedTuple):
    """Rows of a file, and its refused lines: ``(file, line, reason)``."""

    rows: DataFrame
    refused: DataFrame


def set_aside(parsed: DataFrame, reason: Column, file: Column, line: Column, name: str) -> Checked:
    """Split parsed lines in one pass over the files: those without a ``reason`` are good.

    Both parts are written side by side to the shared folder; reading one does not touch the other.
    """
    path = fresh_path(parsed.sparkSession, name)
    refused = F.when(reason.isNotNull(), F.struct(file.alias("file"), line.alias("line"), reason.alias("reason")))
    row = F.when(reason.isNull(), F.struct("*"))
    kind = F.when(reason.isNull(), "rows").otherwise("refused")
    split = parsed.select(row.alias("row"), refused.alias("refused"), kind.alias("kind"))
    split.write.partitionBy("kind").parquet(path)
    stored = parsed.sparkSession.read.schema(split.schema).parquet(path)
    return Checked(
        stored.where("kind = 'rows'").select("row.*"), stored.where("kind = 'refused'").select("refused.*")
    )


def line_position() -> Column:
    """Where a line stands among all lines of the files of a scan, in the order of file names.

    Made of the file, the place in it where the task's part of the file begins, and the order in which the task
    read the line. It must be taken from the scan itself, before anything moves the rows.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("turn"),
    )


def read_json_lines(spark: SparkSession, path: str, id_type: str = "string") -> Checked:
    """JSON lines with ``tweet_id`` and ``text``: ``(doc_id, text, position)``, broken lines set aside.

    ``position`` puts lines in the order of the files, so that of an id's lines the last one can win. A
    line is refused if it is no JSON object, if a value is not of its type, or if it has no id; blank lines are
    no lines.
    """
    schema = f"tweet_id {id_type}, text string, _broken string"
    options = {"columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), line_position().alias("position")
    )
    parsed = lines.where("trim(value) <> ''").select(
        "value", "file", "position", F.from_json("value", schema, options).alias("parsed")
    )
    reason = F.when(~F.col("value").rlike(r"^\s*\{"), "no object")
    reason = reason.when(F.col("parsed._broken").isNotNull(), "not readable")
    reason = reason.when(F.col("parsed.tweet_id").isNull(), "no id")
    found = set_aside(parsed, reason, F.col("file"), F.col("value"), "json-lines")
    rows = found.rows.select(F.col("parsed.tweet_id").alias("doc_id"), "parsed.text", "position")
    return Checked(rows, found.refused)


def read_checked_columns(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", multiline: bool = False
) -> Checked:
    """``read_csv_columns`` with lines of too few or too many fields set aside."""
    scan = spark.read.option("header", True).option("sep", sep).option("multiLine", multiline)
    head = scan.csv(path).columns
    schema = ", ".join(f"`{name}` string" for name in [*head, "_broken"])
    parsed = (
        scan.option("escape", '"')
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", "_broken")
        .option("columnPruning", False)
        .schema(schema)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("_file"))
    )
    reason = F.when(F.col("_broken").isNotNull(), "not as the header")
    found = set_aside(parsed, reason, F.col("_file"), F.col("_broken"), "delimited-lines")
    return Checked(found.rows.select(*columns), found.refused)


def read_conditions(spark: SparkSession, path: str) -> DataFrame:
    """Patient condition rows: ``PATIENT`` and ``CODE``."""
    return read_csv_columns(spark, path, ["PATIENT", "CODE"])


def read_basket_lines(spark: SparkSession, path: str) -> DataFrame:
    """One basket per text line, items joined by a comma and a space.

    The lines carry no key; ``basket_id`` only tells the lines apart.
    """
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("basket_id"),
        F.split("value", ITEM_SEPARATOR).alias("items"),
    )


def read_json_documents(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """JSON lines with ``tweet_id`` and ``text``, as ``doc_id`` and ``text``.

    A line that is no such object stops the job.
    """
    return (
        spark.read.schema(f"tweet_id {id_type}, text string")
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col("tweet_id").alias("doc_id"), "text")
    )


def read_sentences(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The ``sentence_A`` column of a tab-separated file with a header row; see ``read_csv_columns``."""
    return read_csv_columns(spark, path, ["sentence_A"], sep="\t", multiline=multiline)
