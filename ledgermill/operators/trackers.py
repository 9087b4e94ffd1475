"""Typed projections to the tracker tables and message labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


def invoice_tracker(drafts: DataFrame) -> DataFrame:
    """Invoice tracker rows; a null column is a property that is left out.

    ``drafts`` also has subject and file_url.
    """
    vendor = F.col("vendor_display_name")
    return drafts.select(
        "message_id",
        S.title(vendor, F.col("subject"), default="Invoice").alias("name"),
        S.truncate_text(vendor).alias("vendor"),
        S.truncate_text(F.col("invoice_number")).alias("po_number"),
        S.truncate_text(F.col("memo")).alias("notes"),
        S.select_option(F.lit("Received")).alias("status"),
        F.col("total_amount").alias("amount"),
        S.date_start(F.col("invoice_date")).alias("date"),
        S.date_start(F.col("due_date")).alias("due_date"),
        S.email_link(F.col("message_id")).alias("email_link"),
        S.file_property(F.col("file_url")).alias("invoice_file"),
    )


def shipping_tracker(shipments: DataFrame) -> DataFrame:
    """Shipping tracker rows; ``shipments`` has message_id and the shipping payload."""
    carrier, tracking = F.col("carrier"), F.col("tracking_number")
    return shipments.select(
        "message_id",
        S.shipment_title(carrier, tracking, F.col("order_number")).alias("name"),
        S.truncate_text(tracking).alias("tracking_number"),
        S.truncate_text(F.col("order_number")).alias("order_number"),
        S.truncate_text(F.col("vendor_name")).alias("vendor"),
        S.delivery_status(F.col("delivery_status")).alias("status"),
        S.carrier_option(carrier).alias("carrier"),
        S.date_start(F.col("shipment_date")).alias("date"),
        S.date_start(F.col("estimated_delivery")).alias("expected_delivery"),
        S.truncate_text(F.col("delivery_status")).alias("latest_event"),
        S.tracking_link(carrier, tracking).alias("tracking_link"),
        S.email_link(F.col("message_id")).alias("email_link"),
        S.shipment_items_text(F.col("items")).alias("items_text"),
    )


def client_tracker(notes: DataFrame) -> DataFrame:
    """Client communication rows; ``notes`` has the client payload and mail_subject."""
    return notes.select(
        "message_id",
        S.title(F.col("subject"), F.col("mail_subject"), default="Client Communication").alias("subject"),
        S.truncate_text(F.col("client_name")).alias("client_name"),
        S.truncate_text(F.col("project_name")).alias("project"),
        S.truncate_text(F.col("summary")).alias("summary"),
        S.truncate_text(S.bullets(F.col("action_items"))).alias("action_items"),
        S.truncate_text(S.bullets(F.col("key_dates"))).alias("key_dates"),
        S.truncate_text(F.col("notes")).alias("notes"),
        S.truncate_text(F.col("mail_subject")).alias("email_subject"),
        S.checkbox(F.col("response_needed")).alias("response_needed"),
        S.urgency_option(F.col("urgency")).alias("urgency"),
        S.email_link(F.col("message_id")).alias("email_link"),
    )


def label_updates(labels: DataFrame) -> DataFrame:
    """The one category each message ends up with: its latest label replaces earlier ones.

    ``labels`` has message_id, label and seq (order of the updates).
    """
    latest = labels.groupBy("message_id").agg(F.max_by("label", F.struct("seq", "label")).alias("label"))
    return latest.select("message_id", F.array(S.label_category(F.col("label"))).alias("categories"))


def route(label: Column, has_attachment: Column) -> Column:
    """Where a labelled message goes: an invoice needs an attachment."""
    return (
        F.when(label == "shipping", "shipping")
        .when(label == "client_communications", "client_communications")
        .when(label == "insurance", "insurance")
        .when((label == "invoice") & has_attachment, "invoice")
        .otherwise("no_valid_data")
    )
