"""One named query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import scalars as S
from ..functions import similarity as fuzzy_text
from ..functions import text as T
from ..operators import duplicates as D
from ..operators import ledger as L
from ..operators import models as M
from ..operators import resolve as R
from ..operators import trackers as K
from ..operators.inorder import post_in_order as post_batch
from ..operators.joins import keyed_join
from ..operators.posting import Posting, post_drafts
from ..session import cut_lineage, fresh_path
from ..sources import documents as docs
from ..sources import masters, messages, processed
from ..streaming import ingest
from . import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RUN_DATE = "2026-01-01"
FILE_BASE = "https://files.example.com/attachments/"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def money(c: Column | str, places: int = 2) -> Column:
    """A double sum as a decimal, so that the order of addition does not show."""
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(18,{places})")


# --- scans and sources ---------------------------------------------------------------


@query
def scan_messages(spark, sf):
    mail = V.page_mail(spark, sf).unionByName(V.document_mail(spark, sf))
    return messages.scan_messages(mail).select(
        "message_id", "subject", "text",
        F.coalesce(F.size("attachments"), F.lit(0)).alias("n_attachments"),
    )


@query
def flatten_mime_parts(spark, sf):
    parts = messages.flatten_mime_parts(V.mime_mail(spark, sf))
    return parts.select(
        "message_id",
        F.array_join(F.transform("part_path", lambda i: i.cast("string")), ".").alias("part_path"),
        "filename", F.col("content").cast("string").alias("content"), "attachment_id",
    )


@query
def header_lookup(spark, sf):
    return messages.parse_mime(V.mime_mail(spark, sf)).select("message_id", "subject")


@query
def first_body_part(spark, sf):
    node = F.from_json("payload", "body struct<data:string>, parts array<struct<body:struct<data:string>>>")
    data = messages.first_body_part(F.col("n.body.data"), F.col("n.parts.body.data"))
    return V.mime_mail(spark, sf).select("message_id", node.alias("n")).select(
        "message_id", T.decode_base64url_text(data).alias("text")
    )


@query
def scan_masters(spark, sf):
    customers = V.customers(spark, sf).select(
        F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), "ord", "display_name",
        S.address_line("bill_addr.line1", "bill_addr.line2", "bill_addr.city").alias("detail"),
    )
    vendors = V.vendors(spark, sf).select(
        F.lit("vendor").alias("kind"), F.col("vendor_id").alias("id"), "ord", "display_name",
        F.lit(None).cast("string").alias("detail"),
    )
    accounts = V.accounts(spark, sf).select(
        F.lit("account").alias("kind"), F.col("account_id").alias("id"), "ord",
        F.col("name").alias("display_name"), F.col("account_type").alias("detail"),
    )
    return customers.unionByName(vendors).unionByName(accounts)


@query
def recent_transactions(spark, sf):
    orders = V.orders_with_customer(spark, sf)
    rows = orders.select(
        V.text("o_orderkey").alias("txn_id"), F.col("o_orderkey").alias("ord"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("party"),
        F.col("o_totalprice").alias("total_amt"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("txn_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.concat(F.lit("INV-"), V.text("o_orderkey"))).alias("doc_number"),
        F.lit(L.PAYMENT_TYPE).alias("payment_type"), "o_orderstatus",
    )
    return masters.recent_transactions(
        rows.filter(F.col("o_orderstatus") != "F"), rows.filter(F.col("o_orderstatus") == "F")
    )


@query
def scan_attachments(spark, sf):
    rows = messages.scan_attachments(V.document_mail(spark, sf))
    return rows.withColumn("content", F.col("content").cast("string"))


@query
def load_processed(spark, sf):
    path = fresh_path(spark, "processed")
    V.processed(spark, sf).write.json(path)
    return processed.load_processed(spark, path)


@query
def scan_documents(spark, sf):
    rows = V.table(spark, sf, "documents").select(
        V.document_name().alias("filename"), F.split("text", "\n").alias("pages")
    )
    return docs.document_text(rows)


# --- sinks -----------------------------------------------------------------------------


@query
def build_bills(spark, sf):
    drafts, _ = L.split_by_total(V.nested_drafts(spark, sf))
    posted = drafts.filter(L.txn_type(F.col("is_receipt")) == "Bill")
    return L.build_bills(posted.withColumn("vendor_name", F.col("vendor_display_name"))).drop("vendor_id", "customer_id")


@query
def build_purchases(spark, sf):
    drafts, _ = L.split_by_total(V.nested_drafts(spark, sf))
    posted = drafts.filter(L.txn_type(F.col("is_receipt")) == "Purchase")
    rows = posted.withColumn("vendor_name", F.col("vendor_display_name"))
    return L.build_purchases(rows, V.accounts(spark, sf), RUN_DATE).drop("vendor_id", "customer_id")


@query
def attachment_links(spark, sf):
    drafts = V.drafts(spark, sf)
    txns = V.table(spark, sf, "orders").select(
        V.text("o_orderkey").alias("message_id"),
        L.txn_type(F.col("o_orderstatus") == "F").alias("txn_type"),
        F.concat(F.lit("T"), V.text("o_orderkey")).alias("txn_id"),
    )
    return L.attachment_links(drafts, txns)


@query
def invoice_tracker(spark, sf):
    drafts = V.drafts(spark, sf).withColumns(
        {
            "subject": F.lit("mail"),
            "file_url": F.when(F.col("priority") != "4-NOT SPECIFIED", S.file_url(F.col("filename"), FILE_BASE)),
        }
    )
    return K.invoice_tracker(drafts).select(
        "*", F.col("invoice_file.name").alias("file_name"), F.col("invoice_file.url").alias("file_url")
    ).drop("invoice_file")


@query
def shipping_tracker(spark, sf):
    return K.shipping_tracker(V.shipments(spark, sf)).drop("items_text")


@query
def client_tracker(spark, sf):
    return K.client_tracker(V.client_notes(spark, sf))


@query
def label_updates(spark, sf):
    labels = V.event_mail(spark, sf).select(
        V.text("user_id").alias("message_id"), "label", F.col("message_id").cast("bigint").alias("seq")
    )
    return K.label_updates(labels).select("message_id", F.array_join("categories", ",").alias("categories"))


@query
def save_processed(spark, sf):
    path = fresh_path(spark, "processed")
    V.processed(spark, sf).write.json(path)
    new = V.event_mail(spark, sf).filter(F.col("label").isin("none", "invoice"))
    processed.save_processed(processed.load_processed(spark, path), new, path)
    return processed.load_processed(spark, path)


def _vendor_masters(spark: SparkSession, sf: str) -> DataFrame:
    """Vendors by distinct part name; the first part gives the position."""
    parts = V.table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("ord"))
    return parts.select(V.text("ord").alias("vendor_id"), "ord", F.col("p_name").alias("display_name"))


def _altered_name() -> Column:
    """A vendor name as a draft might spell it."""
    name, size = F.col("p_name"), F.col("p_size") % 4
    words = F.split(name, " ")
    return (
        F.when(size == 0, F.concat(name, F.lit(" Inc")))
        .when(size == 1, F.concat(F.lit("x"), F.substr(name, F.lit(3))))
        .when(size == 2, F.concat_ws(" ", F.reverse(words)))
        .otherwise(F.concat_ws(" ", "p_name", "p_brand"))
    )


@query
def register_vendors(spark, sf):
    drafts = V.table(spark, sf, "part").select(_altered_name().alias("vendor_display_name"))
    return L.register_vendors(R.resolve_vendors(drafts, _vendor_masters(spark, sf)))


# --- projections, filters, routing -----------------------------------------------------


@query
def route_by_label(spark, sf):
    mail = V.event_mail(spark, sf)
    return mail.select("message_id", K.route(F.col("label"), F.col("has_attachment")).alias("route"))


@query
def route_txn_type(spark, sf):
    receipt = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    return V.table(spark, sf, "orders").select("o_orderkey", L.txn_type(receipt).alias("txn_type"))


@query
def extraction_route(spark, sf):
    route = messages.extraction_route(V.document_name(), F.when(F.col("source") != "src1", F.col("text")))
    return V.table(spark, sf, "documents").select("doc_id", route.alias("route"))


@query
def validate_total(spark, sf):
    good, bad = L.split_by_total(V.nested_drafts(spark, sf))
    kept = good.select("message_id", "total_amount", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(bad.select("message_id", "total_amount", "reason"))


def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Extractor answers for every order, some of them faulty."""
    priority = F.col("o_orderpriority")
    line = F.struct(
        F.when(priority != "2-HIGH", F.lit("goods")).alias("item"),
        F.col("o_totalprice").alias("rate"),
        F.when(priority == "3-MEDIUM", F.lit(0.0)).when(priority == "1-URGENT", F.lit(2.0)).alias("quantity"),
        F.lit("Materials").alias("category"),
    )
    answer = F.to_json(
        F.struct(
            F.when(F.col("o_orderstatus") != "O", F.col("c_name")).alias("vendor_display_name"),
            F.when(priority != "4-NOT SPECIFIED", F.array(line)).alias("line_items"),
            F.lit(1.5).alias("tax"), F.col("o_totalprice").alias("total_amount"),
            F.concat(F.lit("INV-"), V.text("o_orderkey")).alias("invoice_number"),
            F.when(F.col("o_orderstatus") == "F", F.lit(True)).alias("is_receipt"),
            F.col("c_mktsegment").alias("memo"),
        )
    )
    broken = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string")).otherwise(answer)
    return V.orders_with_customer(spark, sf).select(V.text("o_orderkey").alias("message_id"), broken.alias("answer"))


@query
def validate_schema(spark, sf):
    parsed = M.parse_invoices(_payloads(spark, sf))
    return parsed.select("message_id", F.array_join("errors", "; ").alias("errors"))


@query
def draft_projection(spark, sf):
    drafts = M.to_drafts(M.accepted(M.parse_invoices(_payloads(spark, sf))))
    line = F.get("line_items", F.lit(0))
    return drafts.select(
        "message_id", "vendor_display_name", "vendor_company_name", "memo", "tax", "total_amount",
        "invoice_number", "is_receipt", "customer_name",
        F.size("line_items").alias("n_lines"), line["item"].alias("item"), line["rate"].alias("rate"),
        line["quantity"].alias("quantity"), line["category"].alias("category"),
    )


@query
def check_totals(spark, sf):
    checked = L.check_totals(V.nested_drafts(spark, sf))
    return checked.select(
        "message_id", money("total_amount", 4).alias("total_amount"),
        money("computed_total", 4).alias("computed_total"), "mismatch",
    )


@query
def items_total(spark, sf):
    total = S.items_total(F.col("line_items"), F.col("tax"))
    return V.nested_drafts(spark, sf).select("message_id", money(total, 4).alias("total"))


@query
def expense_accounts(spark, sf):
    return masters.expense_accounts(V.accounts(spark, sf))


@query
def first_attachment(spark, sf):
    scanned = messages.scan_messages(V.document_mail(spark, sf))
    named = F.transform("attachments", lambda a: F.struct(a["name"].alias("filename")))
    return scanned.select("message_id", messages.first_attachment(named).alias("filename"))


@query
def shipping_required(spark, sf):
    s = V.shipments(spark, sf)
    order = F.when(F.col("delivery_status") != "lost", F.col("order_number"))
    carrier = F.when(F.col("carrier") != "DHL", F.col("carrier")).otherwise("")
    return s.select("message_id", M.shipping_required(carrier, F.col("tracking_number"), order).alias("has_reference"))


# --- joins -------------------------------------------------------------------------------


@query
def unprocessed_messages(spark, sf):
    rows = processed.unprocessed(V.event_mail(spark, sf), V.processed(spark, sf))
    return rows.select("message_id", "subject", "received_at")


@query
def customer_exact(spark, sf):
    name = F.when(F.col("o_orderstatus") == "F", F.col("c_name")).when(F.col("o_orderstatus") == "P", F.upper("c_name"))
    names = V.orders_with_customer(spark, sf).select("o_orderkey", name.alias("name"))
    return R.customer_exact(names, V.customers(spark, sf)).select(
        "o_orderkey", F.col("master_id").alias("customer_id")
    )


def _addresses(spark: SparkSession, sf: str) -> DataFrame:
    nation = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = keyed_join(V.orders_with_customer(spark, sf), nation, ["c_nationkey"], "inner")
    priority, segment = F.col("o_orderpriority"), F.col("c_mktsegment")
    address = (
        F.when(priority == "1-URGENT", F.concat(F.lit(" "), "n_name"))
        .when(priority == "2-HIGH", F.lower(segment))
        .when(priority == "3-MEDIUM", F.concat(F.lit("Deliver to "), segment, F.lit("  "), "n_name", F.lit(" now")))
        .when(priority == "4-NOT SPECIFIED", F.concat_ws(" ", F.lit("Dock"), V.text("c_nationkey"), "n_name"))
        .otherwise(F.concat(F.lit("nowhere "), V.text("o_orderkey")))
    )
    return rows.select("o_orderkey", address.alias("address"))


@query
def customer_by_address(spark, sf):
    return R.customer_by_address(_addresses(spark, sf).select("address"), V.customers(spark, sf)).select(
        "address", F.col("master_id").alias("customer_id"), F.col("master_name").alias("customer_name")
    )


@query
def customer_fuzzy(spark, sf):
    people = _vendor_masters(spark, sf).select(F.col("vendor_id").alias("customer_id"), "ord", F.upper("display_name").alias("display_name"))
    addresses = V.table(spark, sf, "part").select(_altered_name().alias("address"))
    return R.customer_fuzzy(addresses, people).select(
        "address", F.col("master_id").alias("customer_id"), F.col("master_name").alias("customer_name"),
        F.round("ratio", 6).alias("ratio"),
    )


@query
def vendor_exact(spark, sf):
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"))
    supplier = V.table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit(" \t"), "s_name", F.lit(" \n"))).otherwise(F.lower("s_name")).alias("name"),
    )
    named = keyed_join(lines, supplier, ["s_suppkey"], "inner", spread=["l_orderkey", "l_linenumber"])
    return R.vendor_exact(named, V.vendors(spark, sf)).select(
        "l_orderkey", "l_linenumber", F.col("master_id").alias("vendor_id")
    )


@query
def vendor_fuzzy(spark, sf):
    names = V.table(spark, sf, "part").select(_altered_name().alias("name"))
    return R.vendor_fuzzy(names, _vendor_masters(spark, sf)).select(
        "name", F.col("master_id").alias("vendor_id"), F.col("master_name").alias("vendor_name"),
        F.round("ratio", 6).alias("ratio"),
    )


def _shifted_drafts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Posted bills with totals, and drafts that repeat them with shifted amounts."""
    bills = cut_lineage(D.with_totals(V.bills(spark, sf), V.bill_lines(spark, sf)))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    shift = F.when(status == "F", 0.0).when(status == "P", 0.004).otherwise(0.02)
    day = F.to_date("txn_date")
    drafts = bills.select(
        F.concat(F.lit("d"), "bill_id").alias("message_id"),
        F.when(priority == "1-URGENT", F.col("doc_number"))
        .when(priority == "2-HIGH", F.concat(F.lit("NEW-"), "bill_id"))
        .when(priority == "3-MEDIUM", "").alias("invoice_number"),
        F.col("vendor_name").alias("vendor_display_name"),
        F.when(priority == "4-NOT SPECIFIED", F.col("txn_date")).otherwise(F.date_format(day, "M/d/yyyy")).alias("invoice_date"),
        (F.col("total") + shift).alias("total_amount"),
    )
    return drafts, bills


@query
def dup_by_number(spark, sf):
    drafts, bills = _shifted_drafts(spark, sf)
    return D.dup_by_number(drafts, bills).select("message_id", F.col("num_bill").alias("bill_id"))


@query
def dup_by_vendor_date_amount(spark, sf):
    drafts, bills = _shifted_drafts(spark, sf)
    return D.dup_by_vendor_date_amount(drafts, bills).select("message_id", F.col("amt_bill").alias("bill_id"))


@query
def duplicate_bills(spark, sf):
    drafts, bills = _shifted_drafts(spark, sf)
    return D.duplicate_bills(drafts, bills).select("message_id", "duplicate_of", "duplicate_rule")


def _tracker(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers held by the tracker: those of all receipts."""
    return V.drafts(spark, sf).filter("is_receipt").select(F.col("invoice_number").alias("po_number"))


@query
def post_in_order(spark, sf):
    """All orders as one batch; a customer's drafts share a number, so the first one wins."""
    rows = V.orders_with_customer(spark, sf)
    drafts = rows.select(
        V.text("o_orderkey").alias("message_id"), F.col("o_orderkey").alias("arrival"),
        F.concat_ws(" ", "c_mktsegment", F.lit("Works"), "c_nationkey").alias("vendor_display_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("INV-"), V.text("c_custkey"))).alias("invoice_number"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("invoice_date"),
        F.col("o_totalprice").alias("total_amount"), F.col("o_totalprice").alias("lines_total"),
        (F.col("o_orderstatus") == "F").alias("is_receipt"),
    )
    no_bills = D.with_totals(V.bills(spark, sf), V.bill_lines(spark, sf)).filter(F.lit(False))
    posted = post_batch(drafts, no_bills, V.vendors(spark, sf))
    return posted.select("message_id", "status", "duplicate_of", "duplicate_rule")


@query
def tracker_exists(spark, sf):
    return D.tracker_exists(V.drafts(spark, sf), _tracker(spark, sf)).select("message_id", "exists")


@query
def new_to_tracker(spark, sf):
    return D.new_to_tracker(_numbered_by_customer(spark, sf), _tracker(spark, sf)).select("message_id", "invoice_number")


def _numbered_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Drafts whose number is shared by all drafts of a customer."""
    rows = V.orders_with_customer(spark, sf)
    return rows.select(
        V.text("o_orderkey").alias("message_id"), F.col("o_orderkey").alias("arrival"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("INV-"), V.text("c_custkey"))).alias("invoice_number"),
    )


@query
def default_bank_account(spark, sf):
    return masters.default_bank_account(V.accounts(spark, sf))


@query
def bill_purchase_reconcile(spark, sf):
    drafts, bills = _shifted_drafts(spark, sf)
    purchases = drafts.select(
        F.col("message_id").alias("txn_id"), F.col("vendor_display_name").alias("party"),
        F.col("total_amount").alias("total_amt"), S.normalize_date(F.col("invoice_date")).alias("txn_date"),
    )
    return D.bill_purchase_reconcile(purchases, bills).select("txn_id", "matched_bill")


@query
def category_to_account(spark, sf):
    return V.draft_lines(spark, sf).select(
        "message_id", "item", "category", rules.category_to_account(F.col("category")).alias("account_id")
    )


# --- aggregations --------------------------------------------------------------------------


@query
def bill_totals(spark, sf):
    return D.bill_totals(V.bill_lines(spark, sf)).select("bill_id", money("total").alias("total"))


def _duplicates(txn_type: str, strict: bool) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return D.duplicate_groups(V.transactions(spark, sf), txn_type, strict)

    return run


# Deposits have no party, so there is only one kind of group.
DUPLICATE_AUDITS = {
    "dup_bills_hard": ("Bill", True),
    "dup_bills_soft": ("Bill", False),
    "dup_purchases_hard": ("Purchase", True),
    "dup_purchases_soft": ("Purchase", False),
    "dup_deposits": ("Deposit", False),
    "dup_payments_hard": ("Payment", True),
    "dup_payments_soft": ("Payment", False),
    "dup_bill_payments_hard": ("BillPayment", True),
    "dup_bill_payments_soft": ("BillPayment", False),
}
QUERIES.update({name: _duplicates(*args) for name, args in DUPLICATE_AUDITS.items()})


@query
def dup_summary(spark, sf):
    return D.duplicate_summary(V.transactions(spark, sf))


@query
def dup_members(spark, sf):
    return D.duplicate_members(V.transactions(spark, sf), strict=True)


@query
def dup_members_soft(spark, sf):
    return D.duplicate_members(V.transactions(spark, sf), strict=False)


@query
def customers_context(spark, sf):
    return masters.context_or_notice(masters.customers_context(V.customers(spark, sf)))


# --- selection, order, sets ------------------------------------------------------------------


@query
def first_match(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    return R.first_match(orders.filter(F.col("o_orderstatus") != "P"), ["o_custkey"], "o_orderkey")


@query
def best_match(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return R.best_match(orders, ["o_custkey"], "o_totalprice", 100000.0, "o_orderkey")


@query
def latest_messages(spark, sf):
    return messages.latest_messages(V.event_mail(spark, sf)).select("message_id", "subject", "received_at")


@query
def next_messages(spark, sf):
    rows = processed.next_messages(V.event_mail(spark, sf), V.processed(spark, sf))
    return rows.select("message_id", "received_at")


@query
def export_processed(spark, sf):
    return processed.export_processed(V.processed(spark, sf))


@query
def mark_processed(spark, sf):
    new = V.event_mail(spark, sf).filter(F.col("label").isin("none", "shipping"))
    return processed.mark_processed(V.processed(spark, sf), new)


# --- explode and nested ------------------------------------------------------------------------


def _txn_of(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "orders").select(
        V.text("o_orderkey").alias("message_id"), L.txn_type(F.col("o_orderstatus") == "F").alias("txn_type")
    )


@query
def ledger_lines(spark, sf):
    lines = keyed_join(V.draft_lines(spark, sf), _txn_of(spark, sf), ["message_id"], "inner")
    return L.ledger_lines(lines, ["message_id", "txn_type"])


@query
def tax_lines(spark, sf):
    taxes = keyed_join(V.draft_tax(spark, sf), _txn_of(spark, sf), ["message_id"], "inner")
    return L.tax_lines(taxes, ["message_id", "txn_type"]).withColumn("amount", money("amount", 4))


@query
def ledger(spark, sf):
    """Detail lines and tax lines together, per account and transaction type."""
    lines = ledger_lines(spark, sf).select("txn_type", "account_id", money("amount", 4).alias("amount"))
    taxes = tax_lines(spark, sf).select("txn_type", "account_id", "amount")
    return lines.unionByName(taxes).groupBy("txn_type", "account_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("amount").cast("decimal(18,4)").alias("amount")
    )


@query
def nested_ledger_lines(spark, sf):
    exploded = L.explode_lines(V.nested_drafts(spark, sf), ["message_id"])
    rows = L.ledger_lines(exploded, ["message_id", "pos"])
    return rows.withColumn("amount", money("amount", 4))


def _posting(spark: SparkSession, sf: str) -> Posting:
    drafts = cut_lineage(V.postable_drafts(spark, sf))
    return post_drafts(
        drafts, V.draft_lines(spark, sf), V.bills_of_drafts(drafts), V.vendors(spark, sf),
        V.customers(spark, sf), V.accounts(spark, sf), RUN_DATE,
    )


@query
def post_bills(spark, sf):
    return _posting(spark, sf).bills


@query
def post_purchases(spark, sf):
    return _posting(spark, sf).purchases


@query
def post_rejected(spark, sf):
    return _posting(spark, sf).rejected


@query
def ledger_posted(spark, sf):
    """All lines of a posted batch per account, transaction type and customer."""
    lines = _posting(spark, sf).lines
    return lines.groupBy("txn_type", "account_id", "customer_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(money("amount", 4)).cast("decimal(18,4)").alias("amount")
    )


@query
def resolve_customers(spark, sf):
    drafts = V.postable_drafts(spark, sf).select("message_id", "customer_name", "job_site_address")
    return R.resolve_customers(drafts, V.customers(spark, sf)).select(
        "message_id", "customer_id", "resolved_customer", "customer_match"
    )


@query
def bill_header(spark, sf):
    return L.build_bills(V.drafts(spark, sf)).select("message_id", "txn_date", "due_date", "doc_number")


@query
def shipment_items_text(spark, sf):
    return V.shipments(spark, sf).select("message_id", S.shipment_items_text(F.col("items")).alias("items_text"))


@query
def bullets_text(spark, sf):
    return V.client_notes(spark, sf).select(
        "message_id", S.bullets(F.col("action_items")).alias("actions"), S.bullets(F.col("key_dates")).alias("dates")
    )


def _with_files(spark: SparkSession, sf: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    file = F.struct(V.document_name().alias("filename"), F.col("text").alias("text"))
    scan = F.struct(F.lit("scan.png").alias("filename"), nothing.alias("text"))
    files = F.when(F.col("lang") == "en", F.array(file, scan)).when(F.col("lang") == "fr", F.array(scan)).otherwise(
        F.array().cast("array<struct<filename:string,text:string>>"))
    return V.table(spark, sf, "documents").select("doc_id", "source", files.alias("files"))


@query
def classifier_context(spark, sf):
    return _with_files(spark, sf).select("doc_id", T.classifier_context(F.col("source"), F.col("files")).alias("context"))


@query
def extractor_context(spark, sf):
    return _with_files(spark, sf).select("doc_id", T.extractor_context(F.col("source"), F.col("files")).alias("context"))


# --- scalar functions ------------------------------------------------------------------------------


@query
def normalize_date(spark, sf):
    return V.drafts(spark, sf).select(
        "message_id", S.normalize_date(F.col("invoice_date")).alias("invoice_date"),
        S.normalize_date(F.col("due_date")).alias("due_date"),
    )


@query
def receipt_date(spark, sf):
    run = F.lit(RUN_DATE)
    return V.drafts(spark, sf).select(
        "message_id", S.receipt_date(F.col("invoice_date"), run).alias("invoice_date"),
        S.receipt_date(F.col("due_date"), run).alias("due_date"),
    )


@query
def mime_type(spark, sf):
    return V.drafts(spark, sf).select("filename", S.mime_type(F.col("filename")).alias("content_type"))


@query
def label_category(spark, sf):
    mail = V.event_mail(spark, sf)
    label = F.when(F.col("has_attachment"), F.col("label")).otherwise(F.col("subject"))
    return mail.select("message_id", S.label_category(label).alias("category"))


@query
def line_description(spark, sf):
    return V.draft_lines(spark, sf).select(
        "message_id", S.line_description(F.col("item"), F.col("quantity"), F.col("l_extendedprice")).alias("description")
    )


@query
def truncate_2000(spark, sf):
    return V.table(spark, sf, "documents").select(
        "doc_id", S.truncate_text(F.col("text")).alias("rich_text"), S.title(F.col("text"), default="Invoice").alias("title")
    )


@query
def email_link(spark, sf):
    key = F.when(F.col("priority") == "5-LOW", "").otherwise(F.col("message_id"))
    return V.drafts(spark, sf).select("message_id", S.email_link(key).alias("link"))


@query
def file_property(spark, sf):
    name = F.when(F.col("priority") != "5-LOW", F.col("filename"))
    prop = S.file_property(S.file_url(name, FILE_BASE))
    return V.drafts(spark, sf).select("message_id", prop["name"].alias("file_name"), prop["url"].alias("file_url"))


@query
def tracking_link(spark, sf):
    return V.shipments(spark, sf).select(
        "message_id", S.tracking_link(F.col("carrier"), F.col("tracking_number")).alias("link")
    )


@query
def shipment_title(spark, sf):
    carrier = F.when(F.col("carrier") != "DHL", F.col("carrier")).otherwise("")
    order = F.when(F.col("carrier") != "DHL", F.col("order_number"))
    return V.shipments(spark, sf).select("message_id", S.shipment_title(carrier, F.col("tracking_number"), order).alias("title"))


@query
def delivery_status(spark, sf):
    return V.shipments(spark, sf).select("message_id", S.delivery_status(F.col("delivery_status")).alias("status"))


@query
def carrier_option(spark, sf):
    carrier = F.when(F.col("carrier") != "UPS", F.col("carrier")).otherwise("")
    return V.shipments(spark, sf).select("message_id", S.carrier_option(carrier).alias("carrier"))


@query
def urgency_option(spark, sf):
    return V.client_notes(spark, sf).select("message_id", S.urgency_option(F.col("urgency")).alias("urgency"))


@query
def title_fallbacks(spark, sf):
    return V.client_notes(spark, sf).select(
        "message_id", S.title(F.col("subject"), F.col("mail_subject"), default="Client Communication").alias("title")
    )


@query
def property_values(spark, sf):
    return V.client_notes(spark, sf).select(
        "message_id", S.checkbox(F.col("response_needed")).alias("checked"),
        S.select_option(F.col("subject")).alias("option"),
        S.date_start(F.nullif(F.substr(F.get("key_dates", F.lit(0)), F.lit(1), F.lit(10)), F.lit(""))).alias("starts"),
    )


@query
def html_to_text(spark, sf):
    pages = V.texts(spark, sf, "pages", "page_id", "html")
    return pages.select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query
def decode_base64url(spark, sf):
    encoded = F.translate(F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n=]", ""), "+/", "-_")
    return V.table(spark, sf, "documents").select("doc_id", T.decode_base64url_text(encoded).alias("text"))


@query
def format_address(spark, sf):
    c = V.customers(spark, sf)
    parts = [F.col(f"bill_addr.{p}") for p in ("line1", "line2", "city")]
    return c.select("customer_id", S.address_line(*parts).alias("line"), S.address_key(*parts).alias("key"))


@query
def similarity(spark, sf):
    pairs = V.table(spark, sf, "part").select(_altered_name().alias("a"), F.col("p_name").alias("b")).distinct()
    return pairs.select("a", "b", F.round(fuzzy_text.similarity("a", "b"), 6).alias("ratio"))


@query
def round2(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", S.round2(F.col("o_totalprice") / 3).alias("third"))


@query
def line_amount(spark, sf):
    lines = V.draft_lines(spark, sf)
    quantity = F.when(F.col("quantity") > 10, F.col("quantity"))
    return lines.select("message_id", "item", S.line_amount(F.col("rate"), quantity).alias("amount"))


# --- models ------------------------------------------------------------------------------------------


@query
def classify_messages(spark, sf):
    return M.classify_messages(V.conversation_mail(spark, sf))


@query
def classify_with_model(spark, sf):
    """The hook, with a stand-in model that answers by text length."""

    def make_model():
        import json

        names = ("invoice", "shipping", "spam")
        return lambda text, instructions: json.dumps({"label": names[len(text) % 3]})

    return M.classify_messages(V.conversation_mail(spark, sf), make_model, "Classify this mail.")


@query
def extract_invoice(spark, sf):
    parsed = M.extract_invoices(V.invoice_texts(spark, sf))
    drafts = M.to_drafts(M.accepted(parsed))
    return drafts.select(
        "message_id", "vendor_display_name", "invoice_number", "invoice_date", "tax", "total_amount", "is_receipt",
        F.size("line_items").alias("n_lines"),
        money(S.items_total(F.col("line_items"), F.col("tax")), 4).alias("computed_total"),
    )


@query
def quarantine_invoices(spark, sf):
    rejected = M.quarantined(M.extract_invoices(V.invoice_texts(spark, sf)))
    return rejected.select("message_id", F.array_join("errors", "; ").alias("errors"))


@query
def extract_shipping(spark, sf):
    return M.extract_shipments(V.shipping_texts(spark, sf)).select(
        "message_id", "carrier", "tracking_number", "order_number", "shipment_date", "estimated_delivery",
        "delivery_status", "origin_address", "destination_address", "has_reference",
    )


@query
def extract_client_note(spark, sf):
    return M.extract_client_notes(V.conversation_mail(spark, sf)).select(
        "message_id", "summary", "response_needed", "urgency", F.size("action_items").alias("n_actions")
    )


# --- streaming -----------------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = V.table(spark, sf, name).schema
    return ingest.message_stream(spark, sf, schema, fmt="parquet", pathGlobFilter=f"{name}.parquet")


@query
def stream_ingest(spark, sf):
    events = _stream(spark, sf, "events")
    mail = events.select(V.text("event_id").alias("message_id"), F.col("ts").alias("received_at"), F.col("event_type").alias("subject"))
    return ingest.drain(mail, "ingest")


@query
def stream_dedup(spark, sf):
    ids = _stream(spark, sf, "events").select(V.text("user_id").alias("message_id"))
    return ingest.drain(ingest.dedup(ids), "dedup")


@query
def stream_dedup_bounded(spark, sf):
    """Users seen, with repeats of an id within the horizon dropped; the horizon covers the whole stream."""
    ids = _stream(spark, sf, "events").select(
        V.text("user_id").alias("message_id"), F.col("ts").cast("timestamp_ltz").alias("received_at")
    )
    return ingest.drain(ingest.dedup(ids, "received_at", "3650 days"), "dedup-bounded").select("message_id")


def _files(spark: SparkSession, rows: DataFrame, key: str, n: int = 3) -> DataFrame:
    """A stream over ``rows`` in ``n`` files, one per micro-batch, each with some rows of the others again."""
    path = fresh_path(spark, "inbox")
    copies = rows.withColumn("_part", F.pmod(F.col(key), F.lit(n))).unionByName(
        rows.filter(F.col(key) % 5 == 0).withColumn("_part", F.pmod(F.col(key) + 1, F.lit(n)))
    )
    copies.repartition(n, "_part").sortWithinPartitions("_part").write.option("maxRecordsPerFile", 0).partitionBy("_part").parquet(path)
    return ingest.message_stream(
        spark, path, rows.schema, fmt="parquet", max_files=1, recursiveFileLookup="true", pathGlobFilter="*.parquet"
    )


@query
def stream_posting(spark, sf):
    """Every order as a labelled message in several micro-batches: trackers, ledger, labels and processed marks."""
    drafts = cut_lineage(V.postable_drafts(spark, sf).withColumn("job_site_address", F.lit(None).cast("string")))
    # Written once, as every batch reads them.
    lines, vendors, customers, accounts = (
        cut_lineage(f(spark, sf)) for f in (V.draft_lines, V.vendors, V.customers, V.accounts)
    )
    bills = cut_lineage(V.bills_of_drafts(drafts))
    label = F.when(F.col("o_orderkey") % 3 == 0, "shipping").otherwise("invoice")
    mail = drafts.withColumns({"label": label, "arrival": F.col("o_orderkey"), "has_attachment": F.col("priority") != "1-URGENT"})
    base = fresh_path(spark, "posting")
    handle = ingest.fan_out_sink(
        base,
        {"invoice": lambda rows: rows.withColumns({"subject": F.lit("s"), "memo": F.lit(None).cast("string"), "file_url": F.lit(None).cast("string")})},
        lambda rows: post_drafts(rows, lines, bills, vendors, customers, accounts, RUN_DATE),
    )
    ingest.start_batches(_files(spark, mail, "o_orderkey"), handle, f"{base}/state").awaitTermination()
    marks = ingest.read_fanned(spark, base, "processed").select("message_id")
    tracked = ingest.read_fanned(spark, base, "tracker_invoice").select("message_id", F.lit(True).alias("tracked"))
    posted = ingest.read_posted(spark, base, "bills").select("message_id", "vendor_id").unionByName(
        ingest.read_posted(spark, base, "purchases").select("message_id", "vendor_id")
    ).withColumn("posted", F.lit(True))
    labels = ingest.read_fanned(spark, base, "labels").select("message_id", "label", "route")
    rows = marks.join(labels, "message_id", "left").join(tracked, "message_id", "left").join(posted, "message_id", "left")
    return rows.select(
        "message_id", "label", "route", F.coalesce("tracked", F.lit(False)).alias("tracked"),
        F.coalesce("posted", F.lit(False)).alias("posted"), "vendor_id",
    )


@query
def stream_sink(spark, sf):
    kind = F.col("event_type")
    events = V.table(spark, sf, "events").select("event_id", "event_type", "value")
    mail = ingest.dedup(_files(spark, events, "event_id").select(
        V.text("event_id").alias("message_id"),
        F.when(kind == "purchase", "invoice").when(kind == "click", "shipping").when(kind == "signup", "insurance")
        .when(kind == "view", "client_communications").otherwise("none").alias("label"),
        (F.col("value") >= 10).alias("has_attachment"),
    ))
    base = fresh_path(spark, "sink")
    ingest.start_batches(mail, ingest.routed_sink(base), f"{base}/state").awaitTermination()
    return ingest.read_routed(spark, base).select("message_id", "category", "route")


@query
def stream_dup_by_batch(spark, sf):
    """Orders as drafts, each micro-batch against the posted bills: by number, or by the vendor, date and total of a bill."""
    bills = cut_lineage(V.bills(spark, sf).join(
        V.table(spark, sf, "orders").select(V.text("o_orderkey").alias("bill_id"), F.col("o_totalprice").alias("total")),
        "bill_id",
    ))
    orders = V.table(spark, sf, "orders")
    drafts = _files(spark, orders, "o_orderkey").select(
        V.text("o_orderkey").alias("message_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("INV-"), V.text("o_orderkey"))).alias("invoice_number"),
        F.concat(F.lit("Customer#"), F.lpad(V.text("o_custkey"), 9, "0")).alias("vendor_display_name"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("invoice_date"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1000).otherwise(F.col("o_totalprice") + 0.004).alias("total_amount"),
    )
    base = fresh_path(spark, "dupcheck")
    handle = ingest.duplicate_sink(base, lambda: bills, D.duplicate_bills)
    ingest.start_batches(ingest.dedup(drafts), handle, f"{base}/state").awaitTermination()
    return ingest.read_checked(spark, base).select("message_id", "duplicate_of", "duplicate_rule")
