"""Structured Streaming: message intake, dedup, fan-out and duplicate checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.scalars import label_category, normalize_date
from ..operators.duplicates import new_to_tracker
from ..operators.joins import first_per_key
from ..operators.posting import Posting
from ..operators.trackers import client_tracker, invoice_tracker, route, shipping_tracker
from ..schemas import MESSAGES
from ..session import cut_lineage, discard, fresh_path
from ..sources.processed import unprocessed


def message_stream(
    spark: SparkSession, path: str, schema: str | StructType = MESSAGES,
    fmt: str = "json", max_files: int = 1000, **options: str,
) -> DataFrame:
    """Messages as they arrive as files; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.options(**options).load(path)


def dedup(messages: DataFrame, event_time: str | None = None, horizon: str | None = None) -> DataFrame:
    """Each message id once.

    Without a horizon the state keeps every id for ever, as a processed list does. With
    one, ids may be forgotten once they are older, which bounds the state.
    """
    if horizon is None:
        return messages.dropDuplicates(["message_id"])
    return messages.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["message_id"])


def start(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append a stream to a parquet table; without an interval, take what is there and stop."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is available and return the table it wrote."""
    spark = stream.sparkSession
    path, checkpoint = fresh_path(spark, name), fresh_path(spark, f"{name}-state")
    start(stream, path, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def routed_sink(base: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that writes one batch's routed messages.

    Messages have message_id, label and has_attachment. All routes go out in a single
    write, split by a partition column. The folder of a batch is overwritten
    when the batch is retried, so every message lands once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = batch.withColumn("category", label_category(F.col("label"))).withColumn(
            "route", route(F.col("label"), F.col("has_attachment"))
        )
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{base}/routed/batch={batch_id}")

    return handle


def read_routed(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.option("basePath", f"{base}/routed").parquet(f"{base}/routed/*")


def fan_out_sink(
    base: str, extract: dict[str, Callable[[DataFrame], DataFrame]],
    post: Callable[[DataFrame], Posting] | None = None, arrival: str = "arrival",
) -> Callable[[DataFrame, int], None]:
    """A handler that does everything a message calls for: label, tracker row, ledger entry, processed mark.

    Messages have message_id, label, has_attachment and ``arrival``. A message that an earlier batch has
    handled, and a repeat within the batch, are left out. ``extract`` turns the messages of a route (invoice,
    shipping, client_communications) into drafts, shipments or notes; ``post`` posts drafts. Invoices whose
    number the tracker holds get no second row. Every table has a folder per batch that is overwritten
    when the batch is retried, and only folders of earlier batches are read.
    """
    trackers = {"invoice": invoice_tracker, "shipping": shipping_tracker, "client_communications": client_tracker}

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def put(name: str, rows: DataFrame) -> None:
            rows.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")

        first = first_per_key(batch, ["message_id"], [arrival])
        if batch_id > 0:
            first = unprocessed(first, _earlier(spark, base, "processed", batch_id))
        fresh = cut_lineage(first.withColumn("route", route(F.col("label"), F.col("has_attachment"))))
        put("labels", fresh.select("message_id", "label", F.col(arrival).alias("seq"), "route"))
        for name, payload in extract.items():
            rows = cut_lineage(payload(fresh.filter(F.col("route") == name)))
            if name == "invoice":
                if post is not None:
                    post(rows).write(f"{base}/ledger/batch={batch_id}")
                held = _earlier(spark, base, "tracker_invoice", batch_id) if batch_id > 0 else None
                none = spark.createDataFrame([], "po_number string")
                rows = new_to_tracker(rows, none if held is None else held, arrival)
            put(f"tracker_{name}", trackers[name](rows))
        put("processed", fresh.select("message_id"))

    return handle


def _earlier(spark: SparkSession, base: str, name: str, batch_id: int) -> DataFrame:
    return read_fanned(spark, base, name).filter(F.col("batch") < batch_id)


def read_fanned(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of ``fan_out_sink``: labels, processed, tracker_<route>, with the batch of each row."""
    return spark.read.option("basePath", f"{base}/{name}").parquet(f"{base}/{name}/*")


def read_posted(spark: SparkSession, base: str, part: str) -> DataFrame:
    """A part of all batches' postings: bills, purchases, lines, vendors or rejected."""
    return spark.read.option("basePath", f"{base}/ledger").parquet(f"{base}/ledger/*/{part}")


def duplicate_sink(
    base: str, bills: Callable[[], DataFrame], check: Callable[[DataFrame, DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """A handler that checks a batch of drafts against the bills posted so far.

    ``bills`` is called per batch, so each batch sees what earlier ones have posted.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Written once: a check reads it several times, and each reading would run the stream's own steps again.
        batch = cut_lineage(batch)
        checked = check(batch, bills())
        checked.write.mode("overwrite").parquet(f"{base}/checked/batch={batch_id}")
        discard(batch)

    return handle


def posting_sink(
    base: str, bills: DataFrame, vendors: DataFrame,
    post: Callable[[DataFrame, DataFrame, DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """A handler that posts each batch in order, on top of what earlier batches created.

    ``post`` takes drafts, bills and vendors, as ``post_in_order`` does. Only folders of
    earlier batches are read, so a retried batch does not meet its own first try.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known_bills, known_vendors = bills, vendors
        if batch_id > 0:
            done = read_checked(spark, base).filter(
                (F.col("batch") < batch_id) & (F.col("status") == "created")
            )
            # Positions continue after the existing rows, batch by batch.
            position = F.col("batch") * (1 << 40) + F.col("arrival") + (1 << 50)
            known_bills = bills.unionByName(
                done.filter(~F.col("is_receipt")).select(
                    F.col("message_id").alias("bill_id"), position.alias("ord"), "vendor_name",
                    normalize_date(F.col("invoice_date")).alias("txn_date"),
                    F.col("invoice_number").alias("doc_number"), F.col("lines_total").alias("total"),
                )
            )
            known_vendors = vendors.unionByName(
                done.filter(F.col("vendor_match") == "new")
                .groupBy(F.col("vendor_name").alias("display_name"))
                .agg(F.min(position).alias("ord"))
                .select(F.concat(F.lit("new-"), F.col("ord").cast("string")).alias("vendor_id"), "ord", "display_name")
            )
        posted = post(batch, known_bills, known_vendors)
        posted.write.mode("overwrite").parquet(f"{base}/checked/batch={batch_id}")

    return handle


def read_checked(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.option("basePath", f"{base}/checked").parquet(f"{base}/checked/*")
