"""Content-addressed web archive.

Payloads are stored once each under their SHA-256 digest; record headers are kept exactly, in a table of
their own. A record is put together again by joining its header with the payload that it names.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.frames import cut, drop
from ledgermill.operators.joins import keyed_join

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DATE = "2026-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: every five hexadecimal digits become four letters."""
    digest = F.sha1(payload)
    letters = []
    for at in range(0, 40, 5):
        value = F.conv(F.substring(digest, at + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(31) + 1
            letters.append(F.substr(F.lit(_ALPHABET), place, F.lit(1)))
    return F.concat(*letters)


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write one record per page below ``path``: the tables ``payloads`` and ``records``.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest page_id is a
    response and the others revisit it; smaller payloads are responses all. A null html is an empty
    payload, a null url leaves its header out. Rows that repeat the largest page_id are responses too, and
    a null page_id counts as the smallest. Extra columns are not read; an empty table gives an empty archive.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "check": F.sha1("payload")})
    # Reduced within each task first, so copies are not shuffled. Equal strong digests
    # with unequal second digests would stop the job rather than lose a payload.
    once = rows.groupBy("digest").agg(
        F.any_value("payload").alias("payload"), F.min("check").alias("a"), F.max("check").alias("b")
    )
    clash = F.raise_error(F.lit("two payloads share a digest"))
    once.select(
        "digest", F.when(F.col("a") == F.col("b"), F.col("payload")).otherwise(clash).alias("payload")
    ).write.parquet(os.path.join(path, "payloads"))

    # Without payloads from here on; written once, so that pages are digested once.
    short = cut(rows.select(
        "page_id", "url", "digest", F.length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
    ))
    largest = short.groupBy("digest").agg(F.max("page_id").alias("largest"))
    about = keyed_join(
        short, largest, ["digest"], "inner", force_salt=True, spread=["page_id", "url"], profile=short.select("digest")
    ).withColumn(
        "revisit",
        (F.col("bytes") >= min_bytes) & F.col("largest").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("largest")),
    )
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(_DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("largest")))),
        _line(
            "WARC-Profile",
            F.when(
                F.col("revisit"),
                F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ),
        ),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
    )
    about.select("digest", header.cast("binary").alias("header")).write.parquet(os.path.join(path, "records"))
    drop(short)


def _field(lines: Column, name: str) -> Column:
    """Value of a header line; null if there is none."""
    own = F.filter(lines, lambda line: line.startswith(f"{name}: "))
    return F.substr(F.get(own, F.lit(0)), F.lit(len(name) + 3))


def _page(urn: Column) -> Column:
    number = F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1)
    return F.when(number != "", number).cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: page_id, record_type, refers_to, payload_digest, payload and the whole ``record``.

    The payload of a revisit is that of the record it refers to; its ``record`` ends after the header, as
    written. Header values may hold any character, line ends of other systems included. A payload that does not have the
    strong digest it is stored by, or the one named in its header, stops the job.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(os.path.join(path, "payloads"))
    records = spark.read.schema("digest string, header binary").parquet(os.path.join(path, "records"))
    # Header lines end at CR LF and nowhere else, and the header at the first empty line.
    lines = F.split(F.substring_index(F.col("header").cast("string"), "\r\n\r\n", 1), "\r\n")
    # The digests of a payload are taken once, however many records share it.
    stored = payloads.filter("digest is not null").withColumns({
        "payload_digest": base32_sha1(F.col("payload")), "sound": F.sha2("payload", 256) == F.col("digest"),
    })
    fields = records.withColumn("lines", lines).select(
        "digest", "header",
        _page(_field(F.col("lines"), "WARC-Record-ID")).alias("page_id"),
        _field(F.col("lines"), "WARC-Type").alias("record_type"),
        _page(_field(F.col("lines"), "WARC-Refers-To")).alias("refers_to"),
        F.regexp_extract(_field(F.col("lines"), "WARC-Payload-Digest"), r"^sha1:(.*)$", 1).alias("named"),
    )
    # Records of one much-copied payload are spread over tasks.
    joined = keyed_join(
        fields, stored, ["digest"], "left", force_salt=True, spread=["page_id"], profile=records.select("digest")
    )
    wrong = F.raise_error(F.lit("an archived payload is missing or does not match its digest"))
    tail = F.lit(b"\r\n\r\n")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select(
        "page_id", "record_type", "refers_to",
        F.when((F.col("named") == F.col("payload_digest")) & F.col("sound"), F.col("payload_digest"))
        .otherwise(wrong).alias("payload_digest"),
        "payload", F.concat("header", body, tail).alias("record"),
    )
