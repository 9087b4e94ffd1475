"""Message sources: JSON mail pages, MIME part trees, attachments."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import blank
from ..functions.text import decode_base64, decode_base64url, decode_base64url_text, message_text
from ..schemas import MESSAGES, MIME_NODE


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Mail messages from JSON files with the fixed message schema."""
    return spark.read.schema(MESSAGES).json(path)


def latest_messages(messages: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest messages; planned as a distributed top-n, not a full sort."""
    return messages.orderBy(F.desc("received_at"), F.asc("message_id")).limit(n)


def scan_messages(messages: DataFrame) -> DataFrame:
    """Id, subject, cleaned text and decoded attachments of every message."""
    return messages.select(
        "message_id",
        F.coalesce("subject", F.lit("")).alias("subject"),
        message_text(F.col("body"), F.col("body_type")).alias("text"),
        kept_attachments(F.col("has_attachments"), F.col("attachments")).alias("attachments"),
        "received_at",
    )


def kept_attachments(has_attachments: Column, attachments: Column) -> Column:
    """Attachments that are not inline and have both a name and content, in order."""
    kept = F.filter(
        attachments,
        lambda a: ~F.coalesce(a["is_inline"], F.lit(False))
        & ~blank(a["name"])
        & ~blank(a["content_b64"]),
    )
    return F.when(F.coalesce(has_attachments, F.lit(False)), kept)


def scan_attachments(messages: DataFrame) -> DataFrame:
    """One row per kept attachment with its decoded bytes; positions count kept ones.

    Malformed base64 gives null content; see ``readable_attachments``.
    """
    kept = kept_attachments(F.col("has_attachments"), F.col("attachments"))
    return messages.select("message_id", F.posexplode(kept).alias("pos", "a")).select(
        "message_id",
        "pos",
        F.col("a.name").alias("filename"),
        decode_base64(F.col("a.content_b64")).alias("content"),
    )


def readable_attachments(attachments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attachments with content, and those whose base64 is malformed, with a reason."""
    bad = F.col("content").isNull()
    return attachments.filter(~bad), attachments.filter(bad).drop("content").withColumn(
        "reason", F.lit("content is not base64")
    )


def first_attachment(attachments: Column) -> Column:
    """File name of the first attachment, or null."""
    return F.get(attachments, F.lit(0))["filename"]


def extraction_route(filename: Column, text: Column) -> Column:
    """How an invoice is to be read: from PDF text, from a PDF's image, from an image."""
    lowered = F.lower(filename)
    has_text = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")) >= 10
    pdf = lowered.endswith(".pdf")
    image = lowered.endswith(".jpeg") | lowered.endswith(".jpg") | lowered.endswith(".png")
    return (
        F.when(pdf & has_text, "pdf_text").when(pdf, "pdf_image").when(image, "image")
    )


def header_lookup(headers: Column, name: str) -> Column:
    """Value of a header, names compared without case, last one wins; default empty."""
    same = F.filter(headers, lambda h: F.lower(h["name"]) == name.lower())
    return F.coalesce(F.try_element_at(same, F.lit(-1))["value"], F.lit(""))


def first_body_part(body_data: Column, parts_data: Column) -> Column:
    """Data of the body, else of the first part that has any."""
    with_data = F.filter(parts_data, lambda d: ~blank(d))
    return F.coalesce(F.nullif(body_data, F.lit("")), F.get(with_data, F.lit(0)))


def parse_mime(messages: DataFrame) -> DataFrame:
    """Subject and decoded text of raw MIME messages (message_id, payload JSON)."""
    node = F.from_json("payload", MIME_NODE)
    parts = F.transform(
        F.col("node.parts"), lambda p: F.from_json(p, "body struct<data:string>")["body"]["data"]
    )
    data = first_body_part(F.col("node.body.data"), parts)
    return messages.select("message_id", node.alias("node")).select(
        "message_id",
        header_lookup(F.col("node.headers"), "subject").alias("subject"),
        F.coalesce(
            message_text(decode_base64url_text(data), F.lit("html")), F.lit("")
        ).alias("text"),
    )


# Messages that are opened between two handovers to the JVM.
_OPENED = 256
_PART = "part_path array<int>, filename string, data string, attachment_id string"


def _text(value) -> str | None:
    """A JSON value as the text a string field holds."""
    return value if value is None or isinstance(value, str) else json.dumps(value)


def parts_of(payload: str | None) -> Iterator[tuple[list[int], str, str | None, str | None]]:
    """(path, filename, data, attachment id) of every part of a tree that has a name and data or an id.

    Children of a part with a name and inline data are not visited. The tree is walked with a stack, whatever its depth; text that is no
    JSON, or nested beyond what the parser reads, has no parts.
    """
    try:
        start = json.loads(payload) if payload is not None else None
    except (ValueError, RecursionError):
        return
    stack: list[tuple[list[int], object]] = [([], start)]
    while stack:
        path, node = stack.pop()
        if not isinstance(node, dict):
            continue
        body = node.get("body")
        body = body if isinstance(body, dict) else {}
        name, data, stored = (_text(v) or None for v in (node.get("filename"), body.get("data"), body.get("attachmentId")))
        if name and (data or stored):
            yield path, name, data, stored
        children = node.get("parts")
        if isinstance(children, list) and not (name and data):
            stack.extend(([*path, k], child) for k, child in reversed(list(enumerate(children))))


def flatten_mime_parts(messages: DataFrame) -> DataFrame:
    """Attachment parts of MIME trees (message_id, payload JSON), one row per part, however deep; see ``parts_of``.

    One lazy step without a shuffle. Malformed base64 gives null content and null attachment_id.
    """
    rows = messages.select("message_id", F.col("payload").cast("string").alias("payload"))
    key = rows.schema["message_id"].dataType.simpleString()
    schema = f"message_id {key}, {_PART}"

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _OPENED):
                ids, payloads = (c.slice(at, _OPENED) for c in batch.columns)
                found = [(k, *part) for k, payload in enumerate(payloads.to_pylist()) for part in parts_of(payload)]
                if found:
                    owner, *columns = zip(*found)
                    kinds = (pa.list_(pa.int32()), pa.string(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(owner)), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                        names=["message_id", "part_path", "filename", "data", "attachment_id"],
                    )

    return rows.mapInArrow(opened, schema).select(
        "message_id", "part_path", "filename",
        F.when(F.col("data").isNotNull(), decode_base64url(F.col("data"))).alias("content"),
        F.when(F.col("data").isNull(), F.col("attachment_id")).alias("attachment_id"),
    )
