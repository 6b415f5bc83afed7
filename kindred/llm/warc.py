"""Web archives with revisit records in place of repeated payloads."""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.storage import fresh_path, staged

MIN_PAYLOAD = 100
# Bounds of a file before compression, which one larger record may exceed. Pages of up to SIZE_STEP bytes are
# written together, those of up to eight times as many, and so on.
RECORDS_PER_FILE, FILE_BYTES, SIZE_STEP = 2000, 1 << 27, 1 << 16
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long"
)


def _record_id(page_id: Column, digest: Column) -> Column:
    d = F.md5(F.concat_ws(":", page_id.cast("string"), digest))
    cut = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _uri(url: Column) -> Column:
    """A header must not be broken by line breaks or other controls in an address."""
    return F.regexp_replace(url, r"[\x00-\x20\x7F]", "%20")


def originals(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``(digest, first_id, first_url)`` of every payload that several pages have.

    Only headers are shuffled, by digest, after partial aggregation: a payload that a
    third of all pages have costs one row a task.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    heads = pages.select(
        "page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n")
    ).where(F.col("n") >= min_payload)
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    return (
        heads.groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("n_pages"))
        .where("n_pages > 1 and first is not null")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    )


def records(pages: DataFrame, repeats: DataFrame, date: str = DATE) -> DataFrame:
    """One WARC/1.1 record per page as text, without the two line ends that close it.

    ``repeats`` are the ``originals`` of all pages there are.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    typed = (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("digest", F.sha2("payload", 256))
        .join(repeats.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left")
        .withColumn(
            "again",
            F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")),
        )
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    block = F.when(F.col("again"), http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _uri(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(F.col("again"), F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(
            F.col("again"),
            F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("first_id"), F.col("digest"))),
        ),
        F.when(
            F.col("again"),
            F.concat(F.lit("WARC-Refers-To-Target-URI: "), _uri(F.col("first_url"))),
        ),
        F.concat(F.lit("Page-ID: "), F.col("page_id").cast("string")),
        F.when(F.col("again"), F.concat(F.lit("Refers-To-Page-ID: "), F.col("first_id").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return typed.select(F.concat(head, F.lit(END), block).alias("value"))


def write_archives(
    pages: DataFrame,
    folder: str,
    min_payload: int = MIN_PAYLOAD,
    records_per_file: int = RECORDS_PER_FILE,
    file_bytes: int = FILE_BYTES,
    size_step: int = SIZE_STEP,
) -> None:
    """Write gzipped archives through Spark's own writer, so any file system it knows will do.

    Of pages with equal payloads of at least ``min_payload`` bytes the one with the least id is
    written whole and the others as revisits of it. Smaller payloads are always
    written whole. A null payload is empty; a page without an id is never the original, and
    a payload that only such pages have is written whole each time; repeated rows of the
    original's id are whole as well. No page gives no records. Other columns are ignored.

    Pages of like size are written to a folder of their own, in files of so many records that ``file_bytes`` hold
    them at their largest: a file is read by one task.
    """
    repeats = staged(originals(pages, min_payload), "originals")
    size = F.octet_length(F.coalesce(F.col("html"), F.lit("")))
    # 0 up to size_step bytes, 1 up to eight times as many, and so on; a text has less than 2 GB.
    step = F.ceil(F.log(8.0, F.greatest(size / size_step, F.lit(1.0))) - 1e-9).cast("int")
    steps = sorted({0, *(row[0] for row in pages.select(step).distinct().collect())})
    for k in steps:
        most = max(1, min(records_per_file, file_bytes // (size_step * 8**k)))
        (
            records(pages.where(step == k), repeats)
            .write.option("lineSep", END)
            .option("compression", "gzip")
            .option("maxRecordsPerFile", most)
            .text(f"{folder}/size-{k}")
        )


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("an archive ends within a record")
        yield headers, block


def _page(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    http, _, payload = block.partition(END.encode())
    if kind == "response":
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if found != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
    else:
        size = next(
            int(line.split(b":")[1])
            for line in http.split(b"\r\n")
            if line.lower().startswith(b"content-length:")
        )
    page_id, refers = headers.get("page-id"), headers.get("refers-to-page-id")
    return (
        None if page_id is None else int(page_id),
        headers.get("warc-target-uri"),
        size,
        digest,
        kind,
        None if refers is None else int(refers),
    )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` per record.

    A file is read by one task, record after record; payloads are checked against their digests.
    """
    names = [part.split()[0] for part in ROWS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    shape = pa.schema(list(zip(names, kinds)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as archive:
                    found = [_page(*record) for record in parse_records(archive)]
                columns = list(zip(*found)) if found else [[] for _ in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds)], schema=shape
                )

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select("content").mapInArrow(rows, ROWS)


def archived(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write_archives(pages, folder, min_payload)
    return read_archives(spark, folder)
