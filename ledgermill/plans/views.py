"""The driver's tables seen as mail, drafts, masters and posted transactions.

Everything is derived row by row or by a join on a key, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import category_to_account
from ..operators.joins import keyed_join
from ..session import spread

# Category texts a part may carry; chosen by its size.
CATEGORY_TEXTS = (
    "Materials", "  labor ", "Equipment Rental", "FUEL", "Permits", "plants and soil",
    "Equipment Repair", "Rental", "Office", "Unknown things", "", "Parental leave",
    "garden", "Workers Comp", "Travel Meals", "gas bill", "PROMO",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Chosen columns of a table whose rows need much work each."""
    return spread(table(spark, sf_dir, name).select(*columns))


def text(c: str) -> Column:
    return F.col(c).cast("string")


def category_of_part() -> Column:
    texts = F.array(*[F.lit(t) for t in CATEGORY_TEXTS])
    return F.element_at(texts, (F.col("p_size") % len(CATEGORY_TEXTS) + 1).cast("int"))


# --- masters ---------------------------------------------------------------------


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        text("s_suppkey").alias("vendor_id"),
        F.col("s_suppkey").alias("ord"),
        F.col("s_name").alias("display_name"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the market segment as street and the nation as city.

    Machinery customers ship to another place; furniture customers have no billing address.
    """
    segment = F.col("c_mktsegment")
    address = lambda line1, line2, city: F.struct(
        line1.alias("line1"), line2.alias("line2"), city.alias("city")
    )
    nothing = F.lit(None).cast("string")
    joined = keyed_join(
        table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"),
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
        ["n_nationkey"], "inner",
    )
    return joined.select(
        text("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("ord"),
        F.col("c_name").alias("display_name"),
        F.when(segment != "FURNITURE", address(segment, nothing, F.col("n_name"))).alias("bill_addr"),
        F.when(segment == "MACHINERY", address(F.lit("Dock"), text("n_regionkey"), F.col("n_name")))
        .when(segment == "BUILDING", address(segment, nothing, F.col("n_name")))
        .alias("ship_addr"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("Expense", "Bank", "Credit Card", "Income", "Expense")])
    return table(spark, sf_dir, "nation").select(
        text("n_nationkey").alias("account_id"),
        F.col("n_nationkey").cast("bigint").alias("ord"),
        F.col("n_name").alias("name"),
        F.element_at(kinds, F.col("n_regionkey") + 1).alias("account_type"),
    )


# --- drafts ----------------------------------------------------------------------


def orders_with_customer(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Orders with their customer; ``heavy`` spreads a small scan where much work per row follows."""
    orders = table(spark, sf_dir, "orders")
    return keyed_join(
        (spread(orders) if heavy else orders).withColumnRenamed("o_custkey", "c_custkey"),
        table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"),
        ["c_custkey"], "inner",
    )


def drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One draft per order, flat header fields only (lines are in ``draft_lines``)."""
    number = F.concat(F.lit("INV-"), text("o_orderkey"))
    priority = F.col("o_orderpriority")
    return orders_with_customer(spark, sf_dir).select(
        text("o_orderkey").alias("message_id"),
        F.col("o_orderkey").alias("arrival"),
        F.col("c_name").alias("vendor_display_name"),
        F.when(priority != "5-LOW", number).otherwise("").alias("invoice_number"),
        F.when(priority == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        .alias("invoice_date"),
        F.when(priority == "2-HIGH", F.date_format(F.date_add("o_orderdate", 30), "M/d/yyyy"))
        .when(priority == "3-MEDIUM", "net 30").alias("due_date"),
        F.col("o_totalprice").alias("total_amount"),
        (F.col("o_orderstatus") == "F").alias("is_receipt"),
        F.col("c_mktsegment").alias("memo"),
        priority.alias("priority"),
        F.concat(F.lit("scan_"), text("o_orderkey"), F.when(priority == "1-URGENT", ".PDF")
                 .when(priority == "2-HIGH", ".jpeg").when(priority == "3-MEDIUM", ".png")
                 .otherwise(".heic")).alias("filename"),
    )


def draft_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per lineitem with the part as item, its price as rate.

    The category belongs to the part, so its account is found per part, not per line.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("message_id"),
        F.col("l_partkey").alias("p_partkey"),
        F.col("l_quantity").alias("quantity"),
        "l_extendedprice", "l_tax",
    )
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("item"), F.col("p_retailprice").alias("rate"),
        category_of_part().alias("category"),
        category_to_account(category_of_part()).alias("account_id"),
    )
    return keyed_join(lines, parts, ["p_partkey"], "inner", spread=["message_id", "quantity", "l_extendedprice"]).drop("p_partkey")


def draft_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax per order, added up in exact decimals."""
    tax = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(tax).cast("double").alias("tax"))
        .select(text("l_orderkey").alias("message_id"), "tax")
    )


LINE_CATEGORIES = {"HOUSEHOLD": "Supplies", "FURNITURE": "Office expenses", "MACHINERY": "Equipment"}


def nested_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One draft per order with two lines, built in the row."""
    segment = F.col("c_mktsegment")
    category = F.when(segment == "HOUSEHOLD", "Supplies").when(segment == "FURNITURE", "Office expenses").when(
        segment == "MACHINERY", "Equipment").otherwise(segment)
    goods = F.struct(
        F.concat(F.lit("goods "), segment).alias("item"),
        F.col("o_totalprice").alias("rate"),
        F.when(F.col("o_orderstatus") == "P", F.lit(2.0)).alias("quantity"),
        F.lit(None).cast("string").alias("description"),
        category.alias("category"),
    )
    service = F.struct(
        F.lit("service").alias("item"), F.lit(12.5).alias("rate"),
        (F.col("c_nationkey") + 1).cast("double").alias("quantity"),
        F.lit("on site").alias("description"), F.lit("Cost of Labor").alias("category"),
    )
    tax = F.when(F.col("o_orderstatus") != "O", F.lit(7.25)).otherwise(F.lit(0.0))
    expected = (
        F.col("o_totalprice") * F.when(F.col("o_orderstatus") == "P", 2.0).otherwise(1.0)
        + 12.5 * (F.col("c_nationkey") + 1) + tax
    )
    priority = F.col("o_orderpriority")
    return orders_with_customer(spark, sf_dir).select(
        text("o_orderkey").alias("message_id"),
        F.col("c_name").alias("vendor_display_name"),
        F.lit(None).cast("string").alias("vendor_company_name"),
        F.array(goods, service).alias("line_items"),
        segment.alias("memo"),
        tax.alias("tax"),
        F.when(priority == "1-URGENT", expected).when(priority == "2-HIGH", expected + 1.0)
        .when(priority == "3-MEDIUM", F.lit(0.0)).when(priority == "4-NOT SPECIFIED", F.lit(-5.0))
        .alias("total_amount"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("due_date"),
        F.concat(F.lit("INV-"), text("o_orderkey")).alias("invoice_number"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("invoice_date"),
        (F.col("o_orderstatus") == "F").alias("is_receipt"),
        F.lit(None).cast("string").alias("job_site_address"),
        F.col("c_name").alias("customer_name"),
    )


def postable_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One draft per order from a known or new vendor, some without a total; lines are in ``draft_lines``."""
    names = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Customers buy from all suppliers in turn.
    bounds = names.agg(F.count(F.lit(1)).alias("n"), F.min("s_suppkey").alias("least"))
    supplier = F.col("c_custkey") % bounds.select("n").scalar() + bounds.select("least").scalar()
    orders = orders_with_customer(spark, sf_dir).withColumn("s_suppkey", supplier)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = keyed_join(keyed_join(orders, names, ["s_suppkey"], "inner"), nation, ["c_nationkey"], "inner")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    drafts = rows.select(
        text("o_orderkey").alias("message_id"),
        F.when(F.col("c_custkey") % 4 == 0, F.concat("c_mktsegment", F.lit(" Works")))
        .otherwise(F.concat(F.lit(" "), "s_name")).alias("vendor_display_name"),
        F.when(priority.isin("4-NOT SPECIFIED", "5-LOW"), "").otherwise(F.concat(F.lit("INV-"), text("o_orderkey")))
        .alias("invoice_number"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("invoice_date"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("due_date"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("o_totalprice") + 0.004).alias("total_amount"),
        (status == "F").alias("is_receipt"),
        F.when(status == "F", F.col("c_name")).when(status == "P", F.upper("c_name")).alias("customer_name"),
        F.concat(F.lit("Deliver to "), "c_mktsegment", F.lit("  "), "n_name", F.lit(" now")).alias("job_site_address"),
        "o_orderkey", priority.alias("priority"), "o_totalprice", "o_orderdate",
    )
    return keyed_join(drafts, draft_tax(spark, sf_dir), ["message_id"], "left")


def bills_of_drafts(drafts: DataFrame) -> DataFrame:
    """Bills that were posted before: by number, or by vendor, date and amount."""
    return drafts.filter(F.col("priority").isin("2-HIGH", "4-NOT SPECIFIED")).select(
        F.concat(F.lit("b"), "message_id").alias("bill_id"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("priority") == "2-HIGH", "another vendor").otherwise(F.col("vendor_display_name")).alias("vendor_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("txn_date"),
        F.when(F.col("priority") == "2-HIGH", F.col("invoice_number")).alias("doc_number"),
        F.col("o_totalprice").alias("total"),
    )


# --- posted transactions -----------------------------------------------------------


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posted bill per order; its lines are the order's lineitems."""
    return orders_with_customer(spark, sf_dir).select(
        text("o_orderkey").alias("bill_id"),
        F.col("o_orderkey").alias("ord"),
        F.col("c_name").alias("vendor_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("txn_date"),
        F.concat(F.lit("INV-"), text("o_orderkey")).alias("doc_number"),
        "o_orderpriority", "o_orderstatus",
    )


def bill_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("bill_id"), F.col("l_extendedprice").alias("amount")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted transactions: lineitems by return flag and line status."""
    flags = F.concat("l_returnflag", "l_linestatus")
    kind = (
        F.when(flags == "AF", "Bill").when(flags == "AO", "Purchase")
        .when(flags == "NF", "Deposit").when(flags == "NO", "Payment").otherwise("BillPayment")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        kind.alias("txn_type"),
        F.col("l_suppkey").alias("s_suppkey"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("txn_id"),
        F.col("l_quantity").alias("total_amt"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("txn_date"),
    )
    names = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("party"))
    return keyed_join(lines, names, ["s_suppkey"], "left", spread=["txn_id", "txn_date"]).drop("s_suppkey")


# --- mail --------------------------------------------------------------------------


def event_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled messages: one per event."""
    kind = F.col("event_type")
    label = (
        F.when(kind == "purchase", "invoice").when(kind == "click", "shipping")
        .when(kind == "signup", "insurance").when(kind == "view", "client_communications")
        .otherwise("none")
    )
    return table(spark, sf_dir, "events").select(
        text("event_id").alias("message_id"),
        F.concat_ws(" ", "event_type", "user_id").alias("subject"),
        F.col("ts").alias("received_at"),
        label.alias("label"),
        (F.col("value") >= 10).alias("has_attachment"),
        F.col("user_id"),
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids already handled: all error events."""
    return (
        table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
        .select(text("event_id").alias("message_id"))
    )


def document_name() -> Column:
    suffix = F.when(F.col("lang") == "en", ".pdf").when(F.col("lang") == "fr", ".PDF").when(
        F.col("lang") == "de", ".Jpg").otherwise(".txt")
    return F.concat(F.lit("doc_"), text("doc_id"), suffix)


def document_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with attachments: one per document, its text as attachment."""
    attachment = lambda name, content, inline: F.struct(
        name.alias("name"), content.alias("content_b64"), inline.alias("is_inline")
    )
    content = F.base64(F.encode("text", "UTF-8"))
    rows = texts(spark, sf_dir, "documents", "doc_id", "source", "text", "lang")
    return rows.select(
        text("doc_id").alias("message_id"),
        F.col("source").alias("subject"),
        F.lit("text").alias("body_type"),
        F.col("text").alias("body"),
        (F.col("lang") != "es").alias("has_attachments"),
        F.array(
            attachment(F.lit("logo.png"), F.lit("aGk="), F.lit(True)),
            attachment(document_name(), content, F.lit(False)),
            attachment(F.lit("empty.txt"), F.lit(""), F.lit(False)),
            attachment(F.lit("note.txt"), F.base64(F.encode("source", "UTF-8")), F.lit(None).cast("boolean")),
        ).alias("attachments"),
        F.lit(None).cast("timestamp").alias("received_at"),
    )


def page_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML messages: one per page."""
    nothing = F.lit(None)
    return texts(spark, sf_dir, "pages", "page_id", "url", "html").select(
        F.concat(F.lit("p"), text("page_id")).alias("message_id"),
        F.col("url").alias("subject"),
        F.lit("html").alias("body_type"),
        F.col("html").alias("body"),
        F.lit(False).alias("has_attachments"),
        nothing.cast("array<struct<name:string,content_b64:string,is_inline:boolean>>").alias("attachments"),
        nothing.cast("timestamp").alias("received_at"),
    )


def mime_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw part trees: one per document, as JSON.

    root -> [text body, mixed -> [file with data -> [hidden child], stored file], ten levels -> file]
    """
    b64url = lambda c: F.translate(F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"[\r\n=]", ""), "+/", "-_")
    nothing = F.lit(None).cast("string")
    data = b64url(F.col("text"))
    hidden = F.struct(F.lit("hidden.txt").alias("filename"), F.struct(F.lit("aGk").alias("data")).alias("body"))

    def leaf(filename: Column, data: Column, stored: Column, parts: Column) -> Column:
        body = F.struct(data.alias("data"), stored.alias("attachmentId"))
        return F.struct(filename.alias("filename"), body.alias("body"), parts.alias("parts"))

    def branch(kind: str, data: Column, parts: Column) -> Column:
        body = F.when(data.isNotNull(), F.struct(data.alias("data")))
        return F.struct(F.lit(kind).alias("mimeType"), body.alias("body"), parts.alias("parts"))

    file = leaf(document_name(), data, nothing, F.array(hidden))
    stored = leaf(
        F.concat(F.lit("stored_"), F.col("source")), nothing,
        F.concat(F.lit("att-"), text("doc_id")), F.when(F.lit(False), F.array(hidden)),
    )
    files = F.array(file, stored)
    # A file ten levels down, deeper than the levels that are opened at a time.
    deep = leaf(F.concat(F.lit("deep_"), F.col("source")), nothing, F.concat(F.lit("deep-"), text("doc_id")), nothing)
    for _ in range(10):
        deep = branch("multipart/mixed", nothing, F.array(deep))
    parts = [branch("text/plain", data, nothing), branch("multipart/mixed", nothing, files), deep]
    headers = F.array(
        F.struct(F.lit("From").alias("name"), F.lit("a@example.com").alias("value")),
        F.struct(F.lit("SUBJECT").alias("name"), F.col("lang").alias("value")),
        F.struct(F.lit("Subject").alias("name"), F.concat_ws(" ", "source", "doc_id").alias("value")),
    )
    root = F.concat(
        F.lit('{"mimeType": "multipart/alternative", "headers": '), F.to_json(headers), F.lit(', "parts": ['),
        F.concat_ws(", ", *[F.to_json(part) for part in parts]), F.lit("]}"),
    )
    rows = texts(spark, sf_dir, "documents", "doc_id", "source", "text", "lang")
    return rows.select(text("doc_id").alias("message_id"), root.alias("payload"))


def conversation_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain messages: one per conversation turn and one per document."""
    turns = texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("message_id"), "text"
    )
    docs = texts(spark, sf_dir, "documents", "doc_id", "text").select(F.concat(F.lit("d"), text("doc_id")).alias("message_id"), "text")
    return turns.unionByName(docs)


CARRIERS = ("FedEx", "UPS", "usps", "DHL", "freight")


def carrier_of_order() -> Column:
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "1-URGENT", "FedEx").when(priority == "2-HIGH", "UPS")
        .when(priority == "3-MEDIUM", "usps").when(priority == "4-NOT SPECIFIED", "DHL")
        .otherwise("ABC Freight")
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping payloads: one per order."""
    status = F.col("o_orderstatus")
    item = lambda d, q, w: F.struct(d.alias("description"), q.alias("quantity"), w.alias("weight"))
    return table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("message_id"),
        carrier_of_order().alias("carrier"),
        F.when(status != "O", F.concat(F.lit("1Z"), F.lpad(text("o_orderkey"), 10, "0"))).otherwise("").alias("tracking_number"),
        F.concat(F.lit("PO-"), text("o_custkey")).alias("order_number"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("shipment_date"),
        F.date_format(F.date_add("o_orderdate", 5), "M/d/yyyy").alias("estimated_delivery"),
        F.when(status == "F", "Delivered").when(status == "P", "in transit").otherwise("lost").alias("delivery_status"),
        F.array(
            item(F.lit("pallet"), F.col("o_totalprice"), F.lit("12 lb")),
            item(F.lit("box"), F.lit(0.0), F.lit("")),
            item(F.col("o_orderpriority"), F.lit(3.0), F.lit(None).cast("string")),
        ).alias("items"),
        F.lit(None).cast("string").alias("vendor_name"),
    )


def shipping_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spread(shipments(spark, sf_dir))
    return s.select(
        "message_id",
        F.concat(
            F.lit("Hello,\nYour order "), "order_number", F.lit(" shipped on "), "shipment_date",
            F.lit(" via "), "carrier",
            F.when(F.col("tracking_number") != "", F.concat(F.lit(". Tracking number: "), "tracking_number")).otherwise(""),
            F.lit(". Estimated delivery: "), "estimated_delivery",
            F.when(F.col("delivery_status") == "Delivered", ". It was delivered").otherwise(""),
            F.lit(".\nFrom: Warehouse 9\nTo: Site 4\n"),
        ).alias("text"),
    )


def invoice_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain-text invoices: one per order."""
    return orders_with_customer(spark, sf_dir, heavy=True).select(
        text("o_orderkey").alias("message_id"),
        F.concat(
            F.lit("Vendor: "), "c_name",
            F.lit("\nInvoice: INV-"), text("o_orderkey"),
            F.lit("\nDate: "), F.date_format("o_orderdate", "MM/dd/yyyy"),
            F.when(F.col("o_orderstatus") == "F", "\nPAID").otherwise(""),
            F.lit("\nitem | quantity | rate | category\n"),
            F.col("c_mktsegment"), F.lit(" goods | 2 | $"), F.col("o_totalprice").cast("decimal(14,2)"),
            F.lit(" | Materials\nwork | "), F.col("c_nationkey"), F.lit(" | 12.50 | Labor\n"),
            F.lit("Tax: $7.25\nTotal: $"), F.format_number("o_totalprice", 2), F.lit("\n"),
        ).alias("text"),
    )


def client_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client note payloads: one per conversation turn, the whole text as summary."""
    role = F.col("role")
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"),
        F.when(role != "system", role).alias("client_name"),
        F.when(role == "user", "").when(role == "assistant", F.concat(F.lit("Re "), text("conv_id"))).alias("subject"),
        F.when(role == "user", F.concat(F.lit("Conversation "), text("conv_id"))).alias("mail_subject"),
        F.lit("").alias("project_name"),
        F.col("text").alias("summary"),
        F.split("text", "\n").alias("action_items"),
        F.when(role == "user", F.array(F.lit("03/15/2026 - visit"))).otherwise(F.array().cast("array<string>")).alias("key_dates"),
        F.when(role == "user", F.lit(True)).when(role == "assistant", F.lit(False)).alias("response_needed"),
        F.when(role == "user", "HIGH").when(role == "assistant", "medium").otherwise("critical").alias("urgency"),
        F.lit(None).cast("string").alias("notes"),
    )
