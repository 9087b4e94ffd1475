"""Queries over state: streams that know what they have seen, feeds by page, tables kept by key.

Importing this module completes the catalogue: ``QUERIES`` and ``ORACLES`` hold all queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sql
from ..functions.scalars import label_category
from ..operators import mail_model
from ..operators import trackers as K
from ..operators.inorder import post_in_order
from ..operators.keyed_table import KeyedTable
from ..operators.reconcile import reconcile
from ..session import cut_lineage, fresh_path
from ..sources import feed, messages
from ..streaming import ingest, registers, table_set
from ..streaming.audits import Audit, audit_sink
from ..streaming.links import link_stream
from . import views as V
from .oracle import ORACLES, add
from .queries import QUERIES, query

__all__ = ["ORACLES", "QUERIES"]

# Files of one micro-batch of an inbox.
_FILES = 4


def _inbox(spark: SparkSession, rows: DataFrame, part: str, n: int) -> DataFrame:
    """A stream over ``rows`` whose micro-batches are the values 0 to n - 1 of the column ``part``, in this order."""
    path = fresh_path(spark, "inbox")
    rows = cut_lineage(rows)
    for k in range(n):  # one after another, as file streams go by the time of writing
        rows.filter(F.col(part) == k).repartition(_FILES).write.parquet(f"{path}/{k}")
    return ingest.message_stream(
        spark, path, rows.schema, fmt="parquet", max_files=_FILES, recursiveFileLookup="true", pathGlobFilter="*.parquet"
    )


# --- duplicate check inside a stream ---------------------------------------------------------------

# Positions of drafts start behind all bills; a micro-batch has so many of them.
_BATCH = 1 << 40


def _repeated_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in three micro-batches, some again under new ids in a later or earlier one, or in the same one."""
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    kinds = F.explode(F.array(*[F.lit(k) for k in (0, 1, 2)]))
    key, kind = F.col("o_orderkey"), F.col("kind")
    rows = orders.withColumn("kind", kinds).filter((kind == 0) | (kind == 1) & (key % 5 == 0) | (kind == 2) & (key % 7 == 0))
    part = F.pmod(key + F.when(kind == 1, 1).otherwise(0), F.lit(3))
    number = F.concat(F.lit("INV-"), F.when(key % 11 == 0, key - 1).otherwise(key).cast("string"))
    return rows.withColumn("part", part).select(
        "part",
        F.concat(F.element_at(F.array(*[F.lit(x) for x in ("m", "again", "late")]), kind + 1), key.cast("string")).alias("message_id"),
        ((part + 1) * F.lit(_BATCH) + key * 4 + kind).alias("ord"),
        F.when(kind == 2, "").when(kind == 1, number).when(key % 3 != 0, number).alias("invoice_number"),
        F.concat(F.lit("Customer#"), F.lpad(V.text("o_custkey"), 9, "0")).alias("vendor_display_name"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("invoice_date"),
        F.when((kind == 1) & (key % 2 == 0), F.col("o_totalprice") + 5).otherwise(F.col("o_totalprice") + 0.004 * kind).alias("total_amount"),
    )


@query
def stream_dup_check(spark, sf):
    """Drafts against the bills posted before the stream and against earlier drafts, in whatever micro-batch."""
    bills = V.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        V.text("o_orderkey").alias("bill_id"), F.col("o_orderkey").alias("ord"),
        F.concat(F.lit("Customer#"), F.lpad(V.text("o_custkey"), 9, "0")).alias("vendor_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("txn_date"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("INV-"), V.text("o_orderkey"))).alias("doc_number"),
        F.col("o_totalprice").alias("total"),
    )
    drafts = _inbox(spark, _repeated_orders(spark, sf), "part", 3)
    checked = registers.check_stream(drafts, bills)
    return registers.with_rocksdb(spark, lambda: ingest.drain(checked, "dupcheck")).select(
        "message_id", "duplicate_of", "duplicate_rule"
    )


ORACLES["stream_dup_check"] = """with recursive drafts as (
  select case kind when 0 then 'm' when 1 then 'again' else 'late' end || o_orderkey message_id,
    ((o_orderkey + case when kind = 1 then 1 else 0 end) % 3 + 1) * 1099511627776 + o_orderkey * 4 + kind ord,
    case when kind = 2 or kind = 0 and o_orderkey % 3 = 0 then null
      else 'INV-' || case when o_orderkey % 11 = 0 then o_orderkey - 1 else o_orderkey end end number,
    o_custkey vendor, o_orderdate dated,
    case when kind = 1 and o_orderkey % 2 = 0 then o_totalprice + 5 else o_totalprice + 0.004::double * kind end total
  from orders, (values (0), (1), (2)) k(kind)
  where kind = 0 or kind = 1 and o_orderkey % 5 = 0 or kind = 2 and o_orderkey % 7 = 0
), bills as (
  select cast(o_orderkey as varchar) id, o_orderkey ord, o_custkey vendor, o_orderdate dated, o_totalprice total,
    case when o_orderkey % 2 = 0 then 'INV-' || o_orderkey end number
  from orders where o_orderstatus = 'F'
), holders as (
  select number, min(ord) num_ord, arg_min(id, ord) num_id
  from (select number, ord, id from bills union all select number, ord, message_id from drafts) where number is not null group by number
), ranked as (
  select drafts.*, num_ord, num_id, row_number() over (partition by vendor, dated order by ord) r
  from drafts left join holders on drafts.number = holders.number and num_ord < ord
), walk as (
  select vendor, dated, 0 r, coalesce(held, []) held, null::varchar message_id, null::varchar duplicate_of, null::varchar duplicate_rule
  from (select distinct vendor, dated from drafts)
    left join (select vendor, dated, list({'ord': ord, 'id': id, 'total': total}) held from bills group by all) using (vendor, dated)
  union all
  select vendor, dated, r,
    case when hit is null and num_id is null then list_append(held, {'ord': ord, 'id': message_id, 'total': total}) else held end,
    message_id,
    case when num_id is not null and num_ord <= coalesce(hit.ord, num_ord) then num_id else hit.id end,
    case when num_id is not null and num_ord <= coalesce(hit.ord, num_ord) then 'number' when hit is not null then 'vendor_date_amount' end
  from (
    select d.*, w.held, list_min(list_filter(w.held, lambda e: abs(e.total - d.total) < 0.01::double)) hit
    from walk w join ranked d on d.vendor = w.vendor and d.dated = w.dated and d.r = w.r + 1)
)
select message_id, duplicate_of, duplicate_rule from walk where r > 0"""


# --- paged feed ---------------------------------------------------------------------------------------

# Messages of one page of the feeds below.
_PAGE = 100


def _page_of(key: str) -> Column:
    return F.floor(F.col(key).cast("long") / _PAGE)


@query
def scan_messages_paged(spark, sf):
    """Documents as messages with attachments, read from a feed of pages; each task reads the columns it needs."""
    path = fresh_path(spark, "feed")
    feed.write_pages(V.document_mail(spark, sf).withColumn("page", _page_of("message_id")), path)
    columns = spark.createDataFrame([], feed.SCHEMA).drop("page").schema
    return messages.scan_messages(feed.read_feed(spark, path, columns)).select(
        "message_id", "subject", "text", F.coalesce(F.size("attachments"), F.lit(0)).alias("n_attachments")
    )


add("scan_messages_paged", """
  select cast(doc_id as varchar) message_id, source subject, text,
    case when lang = 'es' then 0 else cast(text <> '' as int) + cast(source <> '' as int) end n_attachments from documents""")


@query
def stream_ingest_paged(spark, sf):
    """Events as a feed that a stream follows, some pages per micro-batch."""
    path = fresh_path(spark, "feed")
    mail = V.event_mail(spark, sf).select("message_id", "subject", "received_at", _page_of("message_id").alias("page"))
    feed.write_pages(mail, path)
    stream = feed.stream_feed(
        spark, path, "message_id string, subject string, received_at timestamp, page long",
        pagesPerTask="4",
    )
    return ingest.drain(stream, "paged").select("message_id", "subject", F.col("received_at").cast("timestamp_ntz").alias("received_at"))


add("stream_ingest_paged", """
  select cast(event_id as varchar) message_id, event_type || ' ' || user_id subject, ts received_at from events""")


# --- several tables in one commit -----------------------------------------------------------------------


def _handled(mail: DataFrame) -> DataFrame:
    """What a message leads to, one struct per table: label and processed mark always, a tracker row by its route."""
    route = K.route(F.col("label"), F.col("has_attachment"))
    rows = mail.withColumn("route", route)

    def row(condition, *columns):
        return F.when(condition, F.struct(*columns))

    number = F.concat(F.lit("INV-"), "message_id")
    return rows.select(
        row(F.lit(True), "message_id", label_category(F.col("label")).alias("category")).alias("labels"),
        row(F.lit(True), "message_id").alias("processed"),
        row(F.col("route") == "invoice", "message_id", number.alias("po_number")).alias("invoices"),
        row(F.col("route") == "shipping", "message_id", F.col("subject").alias("title")).alias("shipments"),
        row(F.col("route") == "client_communications", "message_id", F.col("subject").alias("summary")).alias("notes"),
    )


@query
def stream_fan_out(spark, sf):
    """Every event's label, processed mark and tracker row, all tables of a micro-batch in one commit."""
    base = fresh_path(spark, "fan-out")
    events = V.event_mail(spark, sf).withColumn("part", F.pmod(F.col("message_id").cast("long"), F.lit(3)))
    mail = ingest.dedup(_inbox(spark, events, "part", 3))
    table_set.start(_handled(mail), f"{base}/tables", f"{base}/state").awaitTermination()
    rows = table_set.read_table(spark, f"{base}/tables", "labels")
    marks = table_set.read_table(spark, f"{base}/tables", "processed").withColumn("marked", F.lit(True))
    rows = rows.join(marks, "message_id", "left")
    for name, column in (("invoices", "po_number"), ("shipments", "title"), ("notes", "summary")):
        rows = rows.join(table_set.read_table(spark, f"{base}/tables", name).select("message_id", column), "message_id", "left")
    return rows.select("message_id", "category", "marked", "po_number", "title", "summary")


add("stream_fan_out", """e as (
  select cast(event_id as varchar) message_id, event_type || ' ' || user_id subject, value >= 10 attached,
    case event_type when 'purchase' then 'invoice' when 'click' then 'shipping' when 'signup' then 'insurance'
      when 'view' then 'client_communications' else 'none' end as label from events)""", """
  select message_id, case label when 'invoice' then 'Invoice' when 'shipping' then 'Shipping' when 'insurance' then 'Insurance'
      when 'client_communications' then 'Client Communications' else 'Uncategorized' end category, true marked,
    case when label = 'invoice' and attached then 'INV-' || message_id end po_number,
    case when label = 'shipping' then subject end title, case when label = 'client_communications' then subject end summary
  from e""")


# --- a table kept by key ------------------------------------------------------------------------------


@query
def labels_upserted(spark, sf):
    """The label that each user's latest event gave, kept by user over several micro-batches."""
    base = fresh_path(spark, "labels")
    table = KeyedTable(spark, f"{base}/table", "user string, label string, event long, received_at timestamp", ["user"], 16)
    events = V.table(spark, sf, "events").select(
        V.text("user_id").alias("user"), F.col("event_type").alias("label"), F.col("event_id").alias("event"),
        F.col("ts").cast("timestamp_ltz").alias("received_at"), F.pmod(F.col("event_id"), F.lit(4)).alias("part"),
    )
    stream = _inbox(spark, events, "part", 4)

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, ["received_at", "event"])

    ingest.start_batches(stream, handle, f"{base}/state").awaitTermination()
    return table.read().select("user", "label", "event")


add("labels_upserted", """
  select cast(user_id as varchar) as user, arg_max(event_type, (ts, event_id)) as label, arg_max(event_id, (ts, event_id)) as event
  from events group by user_id""")


# --- one-to-one reconciliation ---------------------------------------------------------------------------


@query
def reconcile_one_to_one(spark, sf):
    """Payments and bills of a nation in steps of amount, many of them alike, dates up to two days apart."""
    orders = V.orders_with_customer(spark, sf)
    step = F.floor(F.col("o_totalprice") / 50000) * 50000.0
    party, day = F.concat(F.lit("n"), V.text("c_nationkey")), F.col("o_orderdate").cast("date")
    bills = orders.filter("o_orderstatus <> 'P'").select(
        V.text("o_orderkey").alias("bill_id"), F.col("o_orderkey").alias("ord"), party.alias("party"), day.alias("day"),
        step.alias("amount"),
    )
    payments = orders.filter("o_orderkey % 3 <> 0").select(
        F.concat(F.lit("t"), V.text("o_orderkey")).alias("txn_id"), F.col("o_orderkey").alias("ord"), party.alias("party"),
        F.when(F.col("o_orderkey") % 50 != 1, F.date_add(day, (F.col("o_orderkey") % 2).cast("int"))).alias("day"),
        (step + F.when(F.col("o_orderkey") % 2 == 0, 0.004).otherwise(0.0)).alias("amount"),
    )
    return reconcile(payments, bills, days=2).select("txn_id", "bill_id")


# Pairs in their order, one after another for every party, with the lists of what has been used.
ORACLES["reconcile_one_to_one"] = """with recursive o as (
  select o.*, c.c_nationkey party, floor(o_totalprice / 50000) * 50000.0::double step, cast(o_orderdate as date) dated
  from orders o join customer c on o.o_custkey = c.c_custkey
), b as (select o_orderkey ord, cast(o_orderkey as varchar) bill_id, party, dated, step amount from o where o_orderstatus <> 'P'
), t as (
  select o_orderkey ord, 't' || o_orderkey txn_id, party, case when o_orderkey % 50 <> 1 then dated + cast(o_orderkey % 2 as int) end dated,
    step + case when o_orderkey % 2 = 0 then 0.004::double else 0.0::double end amount
  from o where o_orderkey % 3 <> 0
), pairs as (
  select t.party, t.ord t_ord, b.ord b_ord, bill_id, row_number() over (partition by t.party order by
      abs(t.dated - b.dated), abs(t.amount - b.amount), t.dated, t.amount, b.dated, b.amount, t.ord, b.ord) r
  from t join b on t.party = b.party and abs(t.amount - b.amount) < 0.01::double and abs(t.dated - b.dated) <= 2
), walk as (
  select distinct party, 0::bigint r, []::bigint[] t_used, []::bigint[] b_used, null::bigint t_ord, null::varchar bill_id from pairs
  union all
  select w.party, p.r, case when free then list_append(t_used, p.t_ord) else t_used end,
    case when free then list_append(b_used, b_ord) else b_used end,
    case when free then p.t_ord end, case when free then p.bill_id end
  from walk w join (select * from pairs) p on w.party = p.party and p.r = w.r + 1,
    lateral (select not list_contains(t_used, p.t_ord) and not list_contains(b_used, b_ord) free)
)
select txn_id, walk.bill_id from t left join walk on walk.t_ord = t.ord and walk.bill_id is not null"""


# --- attachments apart from transactions --------------------------------------------------------------------

_PARTS = 4


@query
def stream_attachment_links(spark, sf):
    """Events as postings; their attachments come earlier, later, too late, twice or never, in micro-batches by arrival."""
    events = V.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ltz").alias("at"))
    key, at = F.col("event_id"), F.col("at")
    first, last = events.agg(F.unix_seconds(F.min("at")), F.unix_seconds(F.max("at"))).first()
    length = ((last or 0) - (first or 0)) // _PARTS + 1
    # The last part only moves the watermark past everything.
    end = events.agg(F.max("at").alias("at")).select(F.lit(-1).cast("long").alias("event_id"), (F.col("at") + F.expr("interval 60 days")).alias("at"))

    def parted(rows: DataFrame) -> DataFrame:
        """By arrival: rows are up to a day late."""
        arrival = F.unix_seconds("at") + F.when(key % 17 == 0, 86400).otherwise(0)
        part = F.greatest(F.lit(0), F.least(F.lit(_PARTS - 1), F.floor((arrival - first) / length)))
        return rows.withColumn("part", F.when(key < 0, _PARTS).otherwise(part))

    posted = parted(events.unionByName(end)).select(
        V.text("event_id").alias("message_id"), F.concat(F.lit("t"), V.text("event_id")).alias("txn_id"), at.alias("posted_at"), "part"
    )
    copies = F.when(key % 5 == 0, 0).when(key % 5 == 4, 2).otherwise(1)
    shift = F.when(key % 5 == 1, F.expr("interval 3 hours")).when(key % 5 == 2, F.expr("interval -1 day")).when(
        key % 5 == 3, F.expr("interval 10 days")).otherwise(F.expr("interval 0 hours"))
    files = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).filter(F.col("copy") <= copies).withColumn("at", at + shift)
    files = parted(files.unionByName(end.withColumn("copy", F.lit(1)))).select(
        V.text("event_id").alias("message_id"), F.concat_ws("-", F.lit("f"), "event_id", "copy").alias("filename"), at.alias("received_at"), "part"
    )
    linked = link_stream(
        _inbox(spark, files, "part", _PARTS + 1).drop("part"), _inbox(spark, posted, "part", _PARTS + 1).drop("part")
    )
    return ingest.drain(linked, "links").filter("message_id <> '-1'")


add("stream_attachment_links", """a as (
  select event_id, 'f-' || event_id || '-' || copy filename, ts + case event_id % 5 when 1 then interval 3 hour when 2 then interval (-1) day
      when 3 then interval 10 day else interval 0 hour end received_at
  from events, (values (1), (2)) c(copy) where copy <= case event_id % 5 when 0 then 0 when 4 then 2 else 1 end)""", """
  select cast(coalesce(a.event_id, t.event_id) as varchar) message_id, filename, 't' || t.event_id txn_id,
    case when filename is null then 'bare' when t.event_id is null then 'rejected' else 'linked' end status
  from a full join events t on a.event_id = t.event_id and received_at >= ts - interval 2 day and received_at <= ts + interval 2 day""")


# --- audits kept up to date -------------------------------------------------------------------------------


@query
def stream_audit(spark, sf):
    """Numbers of duplicate groups after each of three micro-batches of posted transactions."""
    base = fresh_path(spark, "audit")
    txns = V.transactions(spark, sf).withColumn("part", F.pmod(F.col("total_amt").cast("long") + F.length("txn_id"), F.lit(3)))
    audit = Audit(spark, base, 16)
    ingest.start_batches(_inbox(spark, txns, "part", 3), audit_sink(audit), f"{base}/state").awaitTermination()
    states = [audit.read(v).select(F.lit(v).cast("long").alias("batch"), "*") for v in audit.summary.versions()]
    out = states[0]
    for state in states[1:]:
        out = out.unionByName(state)
    return out


add("stream_audit", """t as (
  select case l_returnflag || l_linestatus when 'AF' then 'Bill' when 'AO' then 'Purchase' when 'NF' then 'Deposit' when 'NO' then 'Payment'
      else 'BillPayment' end txn_type, coalesce(s_name, 'Unknown') party, l_quantity amount, cast(l_shipdate as date) dated,
    (cast(l_quantity as bigint) + length(l_orderkey || '-' || l_linenumber)) % 3 part
  from lineitem left join supplier on l_suppkey = s_suppkey
), seen as (select b.batch, t.* from t join (values (0), (1), (2)) b(batch) on part <= batch
), hard as (select batch, txn_type, party, amount, dated, count(*) n from seen group by all
), soft as (select batch, txn_type, amount, dated, sum(n) n, count(*) filter (n > 1) hard from hard group by all
), counted as (select batch, txn_type, cast(sum(hard) as bigint) hard, count(*) filter (n > 1) soft from soft group by all)""", """
  select cast(batch as bigint) batch, txn_type, 'hard' strictness, hard n_groups from counted where txn_type <> 'Deposit'
  union all select batch, txn_type, 'soft', soft from counted""")


# --- SQL only, and a trained classifier -------------------------------------------------------------------


@query
def ledger_lines_sql(spark, sf):
    """Ledger lines of nested drafts, written in SQL over the registered functions."""
    sql.register(spark)
    view = f"drafts_{uuid.uuid4().hex}"
    V.nested_drafts(spark, sf).select("message_id", "line_items", "tax").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT message_id, pos, CAST(line_amount(rate, quantity) AS DECIMAL(18,4)) AS amount,
          CASE WHEN is_tax THEN '31' ELSE expense_account(category) END AS account_id,
          CASE WHEN is_tax THEN item ELSE line_description(item, quantity, rate) END AS description
        FROM invoice_lines(TABLE({view}) PARTITION BY message_id)""")


ORACLES["ledger_lines_sql"] = ORACLES["nested_ledger_lines"]

# Each language has a desk of its own, which decides the label that its mail was given.
DESKS = {"en": "client_communications", "fr": "invoice", "de": "shipping", "es": "insurance"}


def desk_mail(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as mail, labelled by the desk of their language."""
    label = F.create_map(*[F.lit(x) for pair in DESKS.items() for x in pair])[F.col("lang")]
    return V.texts(spark, sf, "documents", "doc_id", "text", "lang").select(
        F.concat(F.lit("d"), V.text("doc_id")).alias("message_id"), "text", label.alias("label")
    )


@query
def classify_trained(spark, sf):
    """Labels of all documents by a model trained on two thirds of them."""
    mail = desk_mail(spark, sf)
    model = mail_model.train_classifier(mail.filter(~mail_model.held_out(F.col("message_id"))))
    return mail_model.classify_trained(mail, model)


# --- posting on top of what earlier batches posted ----------------------------------------------------------


@query
def stream_post_in_order(spark, sf):
    """Drafts in three micro-batches, each posted in order on the bills and vendors that earlier ones made; some come again under new ids."""
    orders = V.orders_with_customer(spark, sf)
    key, numbered = F.col("o_orderkey"), (F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") != "5-LOW")
    copies = orders.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).filter((F.col("again") == 0) | numbered & (key % 10 == 0))
    part = F.pmod(key + F.col("again"), F.lit(3))
    drafts = copies.withColumn("part", part).select(
        "part", F.concat(F.when(F.col("again") == 1, "again").otherwise(""), V.text("o_orderkey")).alias("message_id"),
        (F.col("part") * _BATCH + key * 2 + F.col("again")).alias("arrival"),
        F.concat_ws(" ", "c_mktsegment", F.lit("Works"), "c_nationkey").alias("vendor_display_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("INV-"), V.text("c_custkey"))).alias("invoice_number"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("invoice_date"),
        F.col("o_totalprice").alias("total_amount"), F.col("o_totalprice").alias("lines_total"),
        (F.col("o_orderstatus") == "F").alias("is_receipt"),
    )
    base = fresh_path(spark, "in-order")
    no_bills = spark.createDataFrame([], "bill_id string, ord long, vendor_name string, txn_date string, doc_number string, total double")
    handle = ingest.posting_sink(base, no_bills, V.vendors(spark, sf), post_in_order)
    ingest.start_batches(_inbox(spark, drafts, "part", 3).drop("part"), handle, f"{base}/state").awaitTermination()
    return ingest.read_checked(spark, base).select("message_id", "status", "duplicate_of", "duplicate_rule")


add("stream_post_in_order", """o as (
  select o_orderkey, o_custkey, again, o_orderstatus <> 'F' and o_orderpriority <> '5-LOW' numbered,
    case again when 1 then 'again' else '' end || o_orderkey message_id, (o_orderkey + again) % 3 * 1099511627776 + o_orderkey * 2 + again arrival
  from orders join customer on o_custkey = c_custkey, (values (0), (1)) c(again)
  where again = 0 or o_orderstatus <> 'F' and o_orderpriority <> '5-LOW' and o_orderkey % 10 = 0
), f as (select o_custkey, min(arrival) first, arg_min(message_id, arrival) first_id from o where numbered group by 1)""", """
  select message_id, case when numbered and arrival > first then 'duplicate' else 'created' end status,
    case when numbered and arrival > first then first_id end duplicate_of, case when numbered and arrival > first then 'number' end duplicate_rule
  from o left join f using (o_custkey)""")
