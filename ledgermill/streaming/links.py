"""Attachments that arrive apart from the transactions they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINKED, REJECTED, BARE = "linked", "rejected", "bare"


def link_stream(
    attachments: DataFrame, txns: DataFrame, early: str = "2 days", late: str = "2 days", delay: str = "2 days"
) -> DataFrame:
    """A stream of links between two streams: message_id, filename, txn_id, status.

    ``attachments`` (message_id, filename, received_at) and ``txns`` (message_id, txn_id, posted_at) meet when an attachment was
    received from ``early`` before to ``late`` after the transaction of its message was posted. An attachment
    without a transaction in that time is *rejected*, a transaction without attachments is *bare*; both are told
    apart only when the watermark, ``delay`` behind the newest row of the slower stream, has passed the time in which a
    partner could come, and then leave the state. Rows that arrive behind the watermark are dropped by the engine, which
    counts them. Null message ids meet nothing; rows without a time are taken as they are and never expire, so they are left out.
    """
    a = attachments.filter("received_at is not null").select("message_id", "filename", "received_at").withWatermark("received_at", delay)
    t = txns.filter("posted_at is not null").select(
        F.col("message_id").alias("t_message"), "txn_id", "posted_at"
    ).withWatermark("posted_at", delay)
    near = F.expr(f"received_at >= posted_at - interval {early} and received_at <= posted_at + interval {late}")
    joined = a.join(t, (F.col("message_id") == F.col("t_message")) & near, "full_outer")
    return joined.select(
        F.coalesce("message_id", "t_message").alias("message_id"), "filename", "txn_id",
        F.when(F.col("received_at").isNull(), BARE).when(F.col("posted_at").isNull(), REJECTED).otherwise(LINKED).alias("status"),
    )
