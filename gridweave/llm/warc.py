"""Web archive records with payloads stored once by their digest.

An archive is two tables in a shared folder: `payloads` holds every distinct payload's bytes once,
under its SHA-256, and `records` every record's exact header bytes with that digest. A record's
original bytes are its header and its payload, put together by a join and checked against both
digests.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.common import shared_folder

Batches = Iterator[pa.RecordBatch]

# Fixed value: the alphabet of base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: all records carry one date, so that archives of the same rows are the same
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: str) -> Column:
    """Upper-case base 32 of a column of 40 hexadecimal digits (a SHA-1): 5 digits make 4 letters."""
    value = f"cast(conv(substring({digest}, 5 * (i div 4) + 1, 5), 16, 10) as int)"
    letter = f"substring('{BASE32}', (shiftright({value}, 15 - 5 * (i % 4)) & 31) + 1, 1)"
    return F.expr(f"array_join(transform(sequence(0, 31), i -> {letter}), '')")


def _header(kind: Column, revisits: Column) -> Column:
    """The header block of a record, lines ended by CR LF, with its closing empty line."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    identity = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), identity, F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        # an address never breaks a header line
        F.when(
            F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]", " "))
        ).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1_32"))),
        F.when(
            kind == "revisit",
            F.concat(
                line("WARC-Profile", F.lit(REVISIT)),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), revisits.cast("string"), F.lit(">"))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line(
            "Content-Length",
            F.when(kind == "revisit", F.lit("0")).otherwise(F.col("payload_bytes").cast("string")),
        ),
        F.lit("\r\n"),
    )


def write_archive(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Writes the archive of `pages` (page_id, url, html) into two tables under `folder`.

    Of records with equal payloads of at least `least` bytes, those of the largest page_id are
    responses and the others revisit it. A null html has the empty payload. Records without page_id
    are the response only where no record of the payload has one. Rows repeated with one page_id and
    payload get a record each. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    records = keyed.select(
        "page_id",
        "url",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("sha256"),
        F.sha1("payload").alias("hex"),
    ).select("page_id", "url", "payload_bytes", "sha256", base32_of_hex("hex").alias("sha1_32"))
    # one small row per distinct payload; a payload that a third of the pages share is summed first
    heads = records.groupBy("sha256").agg(F.max("page_id").alias("head"))
    of = records.join(heads, "sha256")
    first = F.col("page_id").eqNullSafe(F.col("head")) | (F.col("payload_bytes") < least)
    kind = F.when(first, "response").otherwise("revisit")
    of.select(
        "page_id", "sha256", _header(kind, F.col("head")).alias("header")
    ).write.parquet(f"{folder}/records")
    # equal digests are equal bytes, so every task sends a payload once and any of them stays
    keyed.select(F.sha2("payload", 256).alias("sha256"), "payload").groupBy("sha256").agg(
        F.first("payload").alias("payload")
    ).write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """sha256, header, payload of every record, the payload joined by its digest and checked.

    A payload whose bytes do not have the digest they are stored under is an error.
    """
    records = spark.read.parquet(f"{folder}/records")
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "sha256",
        F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))).cast("binary"))
        .alias("payload"),
    )
    return records.join(payloads, "sha256", "left")


def records_of(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, record: the bytes of every record as a WARC file holds them.

    A revisit's block is empty; each record ends with two empty lines.
    """
    block = F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return read_archive(spark, folder).select(
        "page_id",
        F.concat(F.col("header").cast("binary"), block, F.lit("\r\n\r\n").cast("binary")).alias("record"),
    )


def _field(name: str) -> Column:
    found = F.regexp_extract("header", f"\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(found != "", found)


def pages_of(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, url, html: the archived pages. A null html has become an empty one."""
    return read_archive(spark, folder).select(
        "page_id", _field("WARC-Target-URI").alias("url"), F.col("payload").cast("string").alias("html")
    )


def _digests(spark: SparkSession, folder: str) -> DataFrame:
    """What the headers say of every record, against the digest and length of the stored bytes."""
    payloads = (
        spark.read.parquet(f"{folder}/payloads")
        .withColumn("found", F.sha2("payload", 256))
        .select(
            F.when(F.col("found") == F.col("sha256"), F.col("sha256"))
            .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))).cast("string"))
            .alias("sha256"),
            F.length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("hex"),
        )
        .select("sha256", "payload_bytes", base32_of_hex("hex").alias("payload_digest"))
    )
    return spark.read.parquet(f"{folder}/records").join(payloads, "sha256")


def archive_digest(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes an archive, reads it back, and gives what it holds per record.

    page_id, payload_bytes, payload_digest, record_type, refers_to; see `write_archive`. Bytes and
    digest are those of the payload that the record's digest leads to; a header that says otherwise
    is an error.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/llm-warc-{uuid.uuid4().hex}"
    write_archive(pages, folder, least)
    said = F.regexp_extract("header", "WARC-Payload-Digest: sha1:([A-Z2-7]{32})\\r", 1)
    digest = F.when(said == F.col("payload_digest"), said).otherwise(
        F.raise_error(F.concat(F.lit("wrong digest in the header of "), F.col("header"))).cast("string")
    )
    return _digests(spark, folder).select(
        "page_id",
        "payload_bytes",
        digest.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract("header", "WARC-Refers-To: <urn:page:(-?[0-9]+)>\\r", 1).alias("refers"),
    ).select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("refers") != "", F.col("refers").cast("long")).alias("refers_to"),
    )
