"""SQL counterparts of the queries, for checking results on the same tables."""

from __future__ import annotations

from .views import CATEGORY_TEXTS

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- building blocks -------------------------------------------------------------------

ORDERS = """o as (
  select o.*, c.c_name, c.c_mktsegment, c.c_nationkey, c.c_custkey
  from orders o join customer c on o.o_custkey = c.c_custkey)"""

DRAFTS = """drafts as (
  select cast(o_orderkey as varchar) message_id, o_orderkey arrival, c_name vendor_display_name,
    case when o_orderpriority <> '5-LOW' then 'INV-' || o_orderkey else '' end invoice_number,
    strftime(o_orderdate, '%Y-%m-%d') iso_date,
    case when o_orderpriority = '3-MEDIUM' then strftime(o_orderdate, '%Y-%m-%d')
      else strftime(o_orderdate, '%m/%d/%Y') end invoice_date,
    case when o_orderpriority = '2-HIGH' then strftime(o_orderdate + interval 30 day, '%Y-%m-%d')
      when o_orderpriority = '3-MEDIUM' then 'net 30' end iso_due,
    o_totalprice total_amount, o_orderstatus = 'F' is_receipt, c_mktsegment memo, o_orderpriority priority,
    'scan_' || o_orderkey || case o_orderpriority when '1-URGENT' then '.PDF' when '2-HIGH' then '.jpeg'
      when '3-MEDIUM' then '.png' else '.heic' end filename
  from o)"""

NESTED = """nested as (
  select cast(o_orderkey as varchar) message_id, c_name, c_mktsegment, o_orderstatus, o_orderdate, o_orderpriority,
    o_totalprice rate1, case when o_orderstatus = 'P' then 2.0::double else 1.0::double end qty1,
    12.5::double rate2, (c_nationkey + 1)::double qty2,
    case when o_orderstatus <> 'O' then 7.25::double else 0.0::double end tax,
    'INV-' || o_orderkey invoice_number
  from o), nested_t as (
  select *, rate1 * qty1 + rate2 * qty2 + tax computed,
    case o_orderpriority when '1-URGENT' then rate1 * qty1 + rate2 * qty2 + tax
      when '2-HIGH' then rate1 * qty1 + rate2 * qty2 + tax + 1.0
      when '3-MEDIUM' then 0.0 when '4-NOT SPECIFIED' then -5.0 end total_amount
  from nested)"""

_CATEGORY_LIST = "[" + ", ".join(_text(t) for t in CATEGORY_TEXTS) + "]"
LINES = f"""lines as (
  select cast(l_orderkey as varchar) message_id, p_name item, p_retailprice rate, l_quantity quantity,
    ({_CATEGORY_LIST})[(p_size % {len(CATEGORY_TEXTS)})::int + 1] category, l_extendedprice
  from lineitem join part on l_partkey = p_partkey)"""

# Category and account, in match order, as the documentation of the rules lists them.
_CATEGORIES = """
accounting 69, advertising 7, automobile 55, auto 55, bank charges 8, bookkeeper 70, building repairs 73,
commissions 9, fees 9, cost of labor 59, labor 59, decks 64, patios 64, disposal 28, dues 10, subscriptions 10,
equipment rental 62, equipment 29, equipment repairs 75, repairs 75, fountain 65, garden lighting 65, lighting 65,
fuel 56, gas and electric 76, gas 76, electric 76, installation 60, insurance 11, job expenses 58, job materials 63,
materials 63, lawyer 71, legal 12, professional fees 12, maintenance 72, maintenance and repair 72, meals 13,
entertainment 13, office 15, office expenses 15, permits 68, plants 66, soil 66, plants and soil 66, promotional 16,
purchases 78, rent 17, lease 17, sprinklers 67, drip systems 67, stationery 19, printing 19, supplies 20, taxes 21,
licenses 21, telephone 77, phone 77, travel 22, travel meals 23, utilities 24, workers compensation 57, workers comp 57"""
_RULE_ROWS = ", ".join(
    f"({i}, {_text(key)}, '{account}')"
    for i, (key, account) in enumerate(rule.strip().rsplit(" ", 1) for rule in _CATEGORIES.split(","))
)
RULES = f"""rules(pos, key, account) as (values {_RULE_ROWS}),
category_list as (select distinct category, lower(trim(category)) norm from lines),
category_map as (
  select c.category, coalesce(
      (select account from rules r where r.key = c.norm),
      (select arg_min(account, pos) from rules r
        where c.norm <> '' and (contains(c.norm, r.key) or contains(r.key, c.norm))),
      '31') account_id
  from category_list c)"""

TXNS = """txns as (
  select case l_returnflag || l_linestatus when 'AF' then 'Bill' when 'AO' then 'Purchase'
      when 'NF' then 'Deposit' when 'NO' then 'Payment' else 'BillPayment' end txn_type,
    s_name party, l_orderkey || '-' || l_linenumber txn_id, l_quantity total_amt,
    strftime(l_shipdate, '%Y-%m-%d') txn_date
  from lineitem left join supplier on l_suppkey = s_suppkey)"""

MAIL = """mail as (
  select cast(event_id as varchar) message_id, event_type || ' ' || user_id subject, ts received_at,
    case event_type when 'purchase' then 'invoice' when 'click' then 'shipping' when 'signup' then 'insurance'
      when 'view' then 'client_communications' else 'none' end label,
    value >= 10 has_attachment, user_id, event_id, event_type
  from events)"""

_CATEGORY = """case {0} when 'invoice' then 'Invoice' when 'shipping' then 'Shipping'
  when 'insurance' then 'Insurance' when 'client_communications' then 'Client Communications'
  when 'none' then 'Uncategorized' else {0} end"""
_ROUTE = """case when label in ('shipping', 'client_communications', 'insurance') then label
  when label = 'invoice' and has_attachment then 'invoice' else 'no_valid_data' end"""
_DOC_NAME = """'doc_' || doc_id || case lang when 'en' then '.pdf' when 'fr' then '.PDF'
  when 'de' then '.Jpg' else '.txt' end"""

SHIPMENTS = """s as (
  select cast(o_orderkey as varchar) message_id,
    case o_orderpriority when '1-URGENT' then 'FedEx' when '2-HIGH' then 'UPS' when '3-MEDIUM' then 'usps'
      when '4-NOT SPECIFIED' then 'DHL' else 'ABC Freight' end carrier,
    case when o_orderstatus <> 'O' then '1Z' || lpad(cast(o_orderkey as varchar), 10, '0') else '' end tracking_number,
    'PO-' || o_custkey order_number, strftime(o_orderdate, '%m/%d/%Y') shipped_text,
    strftime(o_orderdate, '%Y-%m-%d') shipment_date,
    strftime(o_orderdate + interval 5 day, '%Y-%m-%d') estimated_delivery,
    strftime(o_orderdate + interval 5 day, '%-m/%-d/%Y') estimated_text,
    case o_orderstatus when 'F' then 'Delivered' when 'P' then 'in transit' else 'lost' end delivery_status,
    o_totalprice, o_orderpriority
  from orders)"""

NOTES = """n as (
  select conv_id || '-' || turn message_id, role,
    case when role <> 'system' then role end client_name,
    case role when 'user' then '' when 'assistant' then 'Re ' || conv_id end subject,
    case role when 'user' then 'Conversation ' || conv_id end mail_subject,
    text summary
  from conversations)"""


def _html_text(column: str) -> str:
    space = r"[ \t\n\r\f\x0b\x1c-\x1f\x{85}\x{a0}]"
    steps = [
        (r"(?s)<!--.*?-->", ""),
        (r"(?is)<!doctype[^>]*>", ""),
        (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
        (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
        (r"(?is)<template\b[^>]*>.*?</template\s*>", ""),
        (rf"{space}*<[^>]*>{space}*", ""),
        (rf"^{space}+|{space}+$", ""),
        ("&quot;", '"'),
        ("&copy;", "©"),
        ("&middot;", "·"),
        ("&amp;?", "&"),
    ]
    sql = column
    for pattern, replacement in steps:
        sql = f"regexp_replace({sql}, {_text(pattern)}, {_text(replacement)}, 'g')"
    return sql


def _with(*parts: str) -> str:
    *ctes, body = parts
    return f"with {', '.join(ctes)} {body}" if ctes else body


def add(name: str, *parts: str) -> None:
    ORACLES[name] = _with(*parts)


# --- scans and sources -------------------------------------------------------------------

add("scan_messages", f"""
  select 'p' || page_id message_id, url subject, {_html_text('html')} as text, 0 n_attachments from pages
  union all
  select cast(doc_id as varchar), source, text,
    case when lang = 'es' then 0 else cast(text <> '' as int) + cast(source <> '' as int) end from documents""")
add("flatten_mime_parts", f"""
  select cast(doc_id as varchar) message_id, '1.0' part_path, {_DOC_NAME} filename, text as content,
    null::varchar attachment_id from documents where text <> ''
  union all
  select cast(doc_id as varchar), '1.1', 'stored_' || source, null, 'att-' || doc_id from documents
  union all
  select cast(doc_id as varchar), '2' || repeat('.0', 10), 'deep_' || source, null, 'deep-' || doc_id from documents""")
add("header_lookup", "select cast(doc_id as varchar) message_id, source || ' ' || doc_id subject from documents")
add("first_body_part", "select cast(doc_id as varchar) message_id, text from documents")
add("scan_masters", """
  select 'customer' kind, cast(c_custkey as varchar) id, c_custkey ord, c_name display_name,
    case when c_mktsegment <> 'FURNITURE' then c_mktsegment || ', ' || n_name end detail
  from customer join nation on c_nationkey = n_nationkey
  union all select 'vendor', cast(s_suppkey as varchar), s_suppkey, s_name, null from supplier
  union all select 'account', cast(n_nationkey as varchar), n_nationkey, n_name,
    (['Expense', 'Bank', 'Credit Card', 'Income', 'Expense'])[n_regionkey + 1] from nation""")
add("recent_transactions", ORDERS, """r as (
  select cast(o_orderkey as varchar) txn_id, o_orderkey, o_orderstatus,
    case when c_mktsegment <> 'BUILDING' then c_name end party, o_totalprice total_amt,
    strftime(o_orderdate, '%Y-%m-%d') txn_date,
    case when o_orderpriority = '5-LOW' then 'N/A' else 'INV-' || o_orderkey end doc_number from o)""", """
  (select 'Bill' txn_type, txn_id, coalesce(party, 'Unknown') party, total_amt, txn_date, doc_number,
    null::varchar payment_type from r where o_orderstatus <> 'F' order by o_orderkey limit 5)
  union all
  (select 'Purchase', txn_id, coalesce(party, 'N/A'), total_amt, txn_date, null, 'CreditCard'
    from r where o_orderstatus = 'F' order by o_orderkey limit 5)""")
add("scan_attachments", f"""
  select cast(doc_id as varchar) message_id, 0 pos, {_DOC_NAME} filename, text as content
    from documents where lang <> 'es' and text <> ''
  union all select cast(doc_id as varchar), cast(text <> '' as int), 'note.txt', source
    from documents where lang <> 'es' and source <> ''""")
add("load_processed", "select cast(event_id as varchar) message_id from events where event_type = 'error'")
add("scan_documents", f"select {_DOC_NAME} filename, text from documents")

# --- sinks ---------------------------------------------------------------------------------

add("build_bills", ORDERS, NESTED, """
  select message_id, 'Bill' txn_type, c_name vendor_name, strftime(o_orderdate, '%Y-%m-%d') txn_date,
    strftime(o_orderdate, '%Y-%m-%d') due_date, invoice_number doc_number
  from nested_t where total_amount > 0 and o_orderstatus <> 'F'""")
add("build_purchases", ORDERS, NESTED, """
  select message_id, 'Purchase' txn_type, 'CreditCard' payment_type, c_name vendor_name,
    strftime(o_orderdate, '%Y-%m-%d') txn_date,
    (select cast(min(n_nationkey) as varchar) from nation where n_regionkey in (1, 2)) bank_account_id
  from nested_t where total_amount > 0 and o_orderstatus = 'F'""")
add("attachment_links", ORDERS, DRAFTS, """
  select filename file_name, case priority when '1-URGENT' then 'application/pdf' when '2-HIGH' then 'image/jpeg'
      when '3-MEDIUM' then 'image/png' else 'application/octet-stream' end content_type,
    case when is_receipt then 'Purchase' else 'Bill' end txn_type, 'T' || message_id txn_id
  from drafts""")
add("invoice_tracker", ORDERS, DRAFTS, """
  select message_id, vendor_display_name as name, vendor_display_name vendor, nullif(invoice_number, '') po_number,
    memo notes, 'Received' status, total_amount amount, iso_date as date, iso_due due_date,
    'https://outlook.office365.com/mail/id/' || message_id email_link,
    case when priority <> '4-NOT SPECIFIED' then filename end file_name,
    case when priority <> '4-NOT SPECIFIED' then 'https://files.example.com/attachments/' || filename end file_url
  from drafts""")
_LINK = """case when lower(carrier) in ('fedex', 'ups', 'usps') and tracking_number <> ''
  then 'https://www.trackingmore.com/track?number=' || tracking_number || '&express=' || lower(carrier) end"""
_CARRIER = """case lower(carrier) when 'fedex' then 'FedEx' when 'ups' then 'UPS' when 'usps' then 'USPS'
  when 'freight' then 'Freight' else 'Other' end"""
_STATUS = "case lower(delivery_status) when 'delivered' then 'Delivered' when 'in transit' then 'In Transit' else 'Unknown' end"
add("shipping_tracker", SHIPMENTS, f"""
  select message_id, carrier || ' - ' || case when tracking_number <> '' then tracking_number else order_number end as name,
    nullif(tracking_number, '') tracking_number, order_number, null::varchar vendor, {_STATUS} status,
    {_CARRIER} carrier, shipment_date as date, estimated_delivery expected_delivery,
    delivery_status latest_event, {_LINK} tracking_link,
    'https://outlook.office365.com/mail/id/' || message_id email_link from s""")
add("client_tracker", NOTES, """
  select message_id, left(coalesce(nullif(subject, ''), mail_subject, 'Client Communication'), 2000) subject,
    client_name, null::varchar project, left(nullif(summary, ''), 2000) summary,
    left('* ' || replace(summary, chr(10), chr(10) || '* '), 2000) action_items,
    case when role = 'user' then '* 03/15/2026 - visit' end key_dates, null::varchar notes,
    mail_subject email_subject, role = 'user' response_needed,
    case role when 'user' then 'High' when 'assistant' then 'Medium' end urgency,
    'https://outlook.office365.com/mail/id/' || message_id email_link from n""")
add("label_updates", MAIL, f"""
  select cast(user_id as varchar) message_id, {_CATEGORY.format('label')} categories
  from (select user_id, arg_max(label, event_id) label from mail group by user_id)""")
add("save_processed", "select cast(event_id as varchar) message_id from events where event_type in ('error', 'purchase')")

# --- projections, filters, routing -----------------------------------------------------------

add("route_by_label", MAIL, f"select message_id, {_ROUTE} route from mail")
add("route_txn_type", "select o_orderkey, case when o_orderstatus = 'F' then 'Purchase' else 'Bill' end txn_type from orders")
add("extraction_route", r"""
  select doc_id, case when lang in ('en', 'fr') then
      case when source <> 'src1' and length(regexp_replace(text, '^\s+|\s+$', '', 'g')) >= 10 then 'pdf_text' else 'pdf_image' end
    when lang = 'de' then 'image' end route from documents""")
add("validate_total", ORDERS, NESTED, """
  select message_id, total_amount, case when total_amount > 0 then null
    else 'total_amount missing or not positive' end reason from nested_t""")
add("validate_schema", ORDERS, """
  select cast(o_orderkey as varchar) message_id, case when c_mktsegment = 'BUILDING' then
      'no answer'
    else concat_ws('; ', case when o_orderstatus = 'O' then 'vendor_display_name is required' end,
      case when o_orderpriority = '4-NOT SPECIFIED' then 'line_items is required' end,
      case when o_orderpriority = '2-HIGH' then 'line item without item' end,
      case when o_orderpriority = '3-MEDIUM' then 'quantity must be greater than 0' end) end errors
  from o""")
add("draft_projection", ORDERS, """
  select cast(o_orderkey as varchar) message_id, c_name vendor_display_name, null::varchar vendor_company_name,
    c_mktsegment memo, 1.5::double tax, o_totalprice total_amount, 'INV-' || o_orderkey invoice_number,
    o_orderstatus = 'F' is_receipt, null::varchar customer_name, 1 n_lines, 'goods' item, o_totalprice rate,
    case when o_orderpriority = '1-URGENT' then 2.0::double else 1.0::double end quantity, 'Materials' category
  from o where c_mktsegment <> 'BUILDING' and o_orderstatus <> 'O' and o_orderpriority in ('1-URGENT', '5-LOW')""")
add("check_totals", ORDERS, NESTED, """
  select message_id, cast(coalesce(total_amount, computed) as decimal(18,4)) total_amount,
    cast(computed as decimal(18,4)) computed_total, coalesce(abs(total_amount - computed) > 0.01, false) mismatch
  from nested_t""")
add("items_total", ORDERS, NESTED, "select message_id, cast(computed as decimal(18,4)) total from nested_t")
add("expense_accounts", "select cast(n_nationkey as varchar) account_id, n_name as name from nation where n_regionkey in (0, 4)")
add("first_attachment", f"""
  select cast(doc_id as varchar) message_id, case when lang <> 'es' then
    case when text <> '' then {_DOC_NAME} when source <> '' then 'note.txt' end end filename from documents""")
add("shipping_required", SHIPMENTS, """
  select message_id, tracking_number <> '' or delivery_status <> 'lost' or carrier <> 'DHL' has_reference from s""")

# --- joins -------------------------------------------------------------------------------------

add("unprocessed_messages", MAIL, "select message_id, subject, received_at from mail where event_type <> 'error'")
add("customer_exact", ORDERS, """
  select o_orderkey, (select cast(min(c.c_custkey) as varchar) from customer c where c.c_name =
    case o_orderstatus when 'F' then o.c_name when 'P' then upper(o.c_name) end) customer_id from o""")
CUSTOMER_ADDRESSES = """owned as (
  select c_custkey, c_name, lower(c_mktsegment || '  ' || n_name) a from customer join nation on c_nationkey = n_nationkey
    where c_mktsegment <> 'FURNITURE'
  union all select c_custkey, c_name, lower('Dock ' || n_regionkey || ' ' || n_name) from customer
    join nation on c_nationkey = n_nationkey where c_mktsegment = 'MACHINERY'),
owners as (select a, min(c_custkey) c_custkey, arg_min(c_name, c_custkey) c_name from owned group by a)"""
add("customer_by_address", ORDERS, CUSTOMER_ADDRESSES, """wanted as (
  select distinct case o_orderpriority when '1-URGENT' then ' ' || n_name when '2-HIGH' then lower(c_mktsegment)
    when '3-MEDIUM' then 'Deliver to ' || c_mktsegment || '  ' || n_name || ' now'
    when '4-NOT SPECIFIED' then 'Dock ' || c_nationkey || ' ' || n_name else 'nowhere ' || o_orderkey end address
  from o join nation on c_nationkey = n_nationkey)""", """
  select address, cast(min(c_custkey) as varchar) customer_id, arg_min(c_name, c_custkey) customer_name
  from wanted join owners on contains(a, lower(trim(address))) or contains(lower(trim(address)), a)
  group by address""")
add("vendor_exact", """
  select l_orderkey, l_linenumber, case when s_acctbal > 0 then cast(s_suppkey as varchar) end vendor_id
  from lineitem join supplier on l_suppkey = s_suppkey""")

BILLS = """lt as (select l_orderkey, sum(l_extendedprice) total from lineitem group by l_orderkey),
bills as (
  select o_orderkey, cast(o_orderkey as varchar) bill_id, c_name vendor, o_orderdate::date d, o_orderpriority p, o_orderstatus st,
    'INV-' || o_orderkey doc_number, coalesce(total, 0.0) total
  from o left join lt on o_orderkey = l_orderkey),
dr as (
  select 'd' || bill_id message_id, case p when '1-URGENT' then doc_number when '2-HIGH' then 'NEW-' || bill_id
      when '3-MEDIUM' then '' end num, vendor, d, total + case st when 'F' then 0.0 when 'P' then 0.004 else 0.02 end amt
  from bills),
nm as (select message_id, min(b.o_orderkey) k from dr join bills b on b.doc_number = num and num <> '' group by 1),
am as (select message_id, min(b.o_orderkey) k from dr join bills b on b.vendor = dr.vendor and b.d = dr.d
    and abs(b.total - dr.amt) < 0.01 group by 1)"""
add("dup_by_number", ORDERS, BILLS, "select message_id, cast(k as varchar) bill_id from dr left join nm using (message_id)")
add("dup_by_vendor_date_amount", ORDERS, BILLS, "select message_id, cast(k as varchar) bill_id from dr left join am using (message_id)")
add("duplicate_bills", ORDERS, BILLS, """
  select message_id, cast(least(nm.k, am.k) as varchar) duplicate_of,
    case when nm.k is not null and (am.k is null or nm.k <= am.k) then 'number'
      when am.k is not null then 'vendor_date_amount' end duplicate_rule
  from dr left join nm using (message_id) left join am using (message_id)""")
add("bill_purchase_reconcile", ORDERS, BILLS, """
  select message_id txn_id, cast(k as varchar) matched_bill from dr left join am using (message_id)""")
add("post_in_order", ORDERS, """d as (
  select *, case when o_orderstatus <> 'F' and o_orderpriority <> '5-LOW' then
      min(case when o_orderstatus <> 'F' and o_orderpriority <> '5-LOW' then o_orderkey end)
        over (partition by c_custkey) end first_key from o)""", """
  select cast(o_orderkey as varchar) message_id,
    case when first_key < o_orderkey then 'duplicate' else 'created' end status,
    case when first_key < o_orderkey then cast(first_key as varchar) end duplicate_of,
    case when first_key < o_orderkey then 'number' end duplicate_rule from d""")
HELD = "held as (select distinct invoice_number num from drafts where is_receipt and invoice_number <> '')"
add("tracker_exists", ORDERS, DRAFTS, HELD, """
  select message_id, num is not null as exists from drafts left join held on num = invoice_number""")
add("new_to_tracker", ORDERS, DRAFTS, HELD, """b as (
  select o_orderkey, case when o_orderpriority <> '5-LOW' then 'INV-' || c_custkey end num from o)""", """
  select cast(min(o_orderkey) as varchar) message_id, num invoice_number from b
    where num is not null and num not in (select num from held) group by num
  union all select cast(o_orderkey as varchar), null from b where num is null""")
add("default_bank_account", """
  select cast(n_nationkey as varchar) bank_account_id, n_name bank_account_name from nation
  where n_regionkey in (1, 2) order by n_nationkey limit 1""")
add("category_to_account", LINES, RULES, """
  select message_id, item, category, account_id from lines join category_map using (category)""")

# --- aggregations ---------------------------------------------------------------------------------

add("bill_totals", "select cast(l_orderkey as varchar) bill_id, cast(sum(l_extendedprice) as decimal(18,2)) total from lineitem group by 1")
for _name, _type, _keys in (
    ("dup_bills_hard", "Bill", "party, total_amt, txn_date"),
    ("dup_bills_soft", "Bill", "total_amt, txn_date"),
    ("dup_purchases_hard", "Purchase", "party, total_amt, txn_date"),
    ("dup_purchases_soft", "Purchase", "total_amt, txn_date"),
    ("dup_deposits", "Deposit", "total_amt, txn_date"),
    ("dup_payments_hard", "Payment", "party, total_amt, txn_date"),
    ("dup_payments_soft", "Payment", "total_amt, txn_date"),
    ("dup_bill_payments_hard", "BillPayment", "party, total_amt, txn_date"),
    ("dup_bill_payments_soft", "BillPayment", "total_amt, txn_date"),
):
    add(_name, TXNS, f"""
  select {_keys}, count(*) n, min(txn_id) first_id, max(txn_id) last_id from txns
  where txn_type = '{_type}' group by {_keys} having count(*) > 1""")
add("dup_summary", TXNS, """g as (
  select txn_type, grouping(party) is_soft, count(*) n from txns
  group by grouping sets ((txn_type, party, total_amt, txn_date), (txn_type, total_amt, txn_date)))""", """
  select txn_type, case when is_soft = 1 then 'soft' else 'hard' end strictness,
    count(*) filter (n > 1) n_groups
  from g where is_soft = 1 or txn_type <> 'Deposit' group by 1, 2""")
add("dup_members", TXNS, """
  select * from (select *, count(*) over (
    partition by txn_type, case when txn_type <> 'Deposit' then party end, total_amt, txn_date) n from txns) where n > 1""")
add("dup_members_soft", TXNS, """
  select * from (select *, count(*) over (partition by txn_type, total_amt, txn_date) n from txns) where n > 1""")
add("customers_context", """
  select c_custkey ord, '- ' || c_name || ': ' || c_mktsegment || ', ' || n_name ||
    case when c_mktsegment = 'MACHINERY' then ' | Dock, ' || n_regionkey || ', ' || n_name else '' end line
  from customer join nation on c_nationkey = n_nationkey where c_mktsegment <> 'FURNITURE'""")

# --- selection, order, sets -------------------------------------------------------------------------

add("first_match", """
  select o_custkey, min(o_orderkey) o_orderkey, arg_min(o_totalprice, o_orderkey) o_totalprice,
    arg_min(o_orderstatus, o_orderkey) o_orderstatus
  from orders where o_orderstatus <> 'P' group by o_custkey""")
add("best_match", """
  select o_custkey, o_orderkey, o_totalprice from orders where o_totalprice > 100000
  qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1""")
add("latest_messages", MAIL, "select message_id, subject, received_at from mail order by received_at desc, message_id limit 10")
add("next_messages", MAIL, "select message_id, received_at from mail where event_type <> 'error' order by received_at desc, message_id limit 10")
add("export_processed", "select cast(event_id as varchar) message_id from events where event_type = 'error' order by 1")
add("mark_processed", "select cast(event_id as varchar) message_id from events where event_type in ('error', 'click')")

# --- explode and nested ---------------------------------------------------------------------------------

_TYPE = "case when o_orderstatus = 'F' then 'Purchase' else 'Bill' end"
_DESC = "item || ' - Qty: ' || cast(quantity as varchar) || ' @$' || cast(rate as varchar)"
LEDGER = f"""ll as (
  select message_id, {_TYPE} txn_type, rate * quantity amount, account_id, {_DESC} description
  from lines join category_map using (category) join orders on message_id = cast(o_orderkey as varchar)),
tl as (
  select message_id, {_TYPE} txn_type, cast(tax as decimal(18,4)) amount, '31' account_id, 'Tax' description
  from (select cast(l_orderkey as varchar) message_id,
      sum(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))) tax from lineitem group by 1)
    join orders on message_id = cast(o_orderkey as varchar) where tax > 0)"""
add("ledger_lines", LINES, RULES, LEDGER, "select * from ll")
add("tax_lines", LINES, RULES, LEDGER, "select * from tl")
add("ledger", LINES, RULES, LEDGER, """
  select txn_type, account_id, count(*) n_lines, cast(sum(amount) as decimal(18,4)) amount from (
    select txn_type, account_id, cast(amount as decimal(18,4)) amount from ll
    union all select txn_type, account_id, amount from tl) group by 1, 2""")
add("nested_ledger_lines", ORDERS, NESTED, """
  select message_id, 0 pos, cast(rate1 * qty1 as decimal(18,4)) amount,
    case c_mktsegment when 'HOUSEHOLD' then '20' when 'FURNITURE' then '15' when 'MACHINERY' then '29'
      when 'AUTOMOBILE' then '55' when 'BUILDING' then '73' end account_id,
    'goods ' || c_mktsegment || ' - Qty: ' || cast(qty1 as varchar) || ' @$' || cast(rate1 as varchar) description from nested_t
  union all select message_id, 1, cast(rate2 * qty2 as decimal(18,4)), '59',
    'service - Qty: ' || cast(qty2 as varchar) || ' @$12.5' from nested_t
  union all select message_id, 2, cast(tax as decimal(18,4)), '31', 'Tax' from nested_t where tax > 0""")
# An address finds the first customer one of whose addresses it contains or lies in.
POSTABLE = """p as (
  select cast(o_orderkey as varchar) message_id, o.*, s.s_name, s.s_suppkey,
    case when c_custkey % 4 = 0 then c_mktsegment || ' Works' else ' ' || s_name end vendor_text,
    case when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then null else 'INV-' || o_orderkey end number,
    case when c_custkey % 11 <> 0 then o_totalprice + 0.004 end total,
    lower('Deliver to ' || c_mktsegment || '  ' || n_name || ' now') address,
    strftime(o_orderdate, '%Y-%m-%d') iso
  from o join nation on n_nationkey = c_nationkey
    join supplier s on s.s_suppkey = o.c_custkey % (select count(*) from supplier) + (select min(s_suppkey) from supplier)),
a as (
  select c_custkey ord, lower(c_mktsegment || '  ' || n_name) addr from customer join nation on c_nationkey = n_nationkey
    where c_mktsegment <> 'FURNITURE'
  union all select c_custkey, lower('Dock ' || n_regionkey || ' ' || n_name)
    from customer join nation on c_nationkey = n_nationkey where c_mktsegment = 'MACHINERY'),
found as (
  select address, min(ord) ord from (select distinct address from p where o_orderstatus = 'O')
    join a on contains(address, addr) or contains(addr, address) group by 1),
b as (select o_orderkey k, case o_orderpriority when '2-HIGH' then 'another vendor' else vendor_text end vendor, iso,
    case o_orderpriority when '2-HIGH' then number end doc, o_totalprice amount
  from p where o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED')),
hit as (
  select message_id, min(b.k) k from p join b on p.number = b.doc
      or (p.vendor_text = b.vendor and p.iso = b.iso and abs(p.total - b.amount) < 0.01)
    where o_orderstatus <> 'F' and total > 0 group by 1),
resolved as (
  select p.message_id, coalesce(case o_orderstatus when 'F' then c_custkey when 'O' then found.ord end, null) ord,
    case o_orderstatus when 'F' then 'name' when 'O' then case when found.ord is not null then 'address' end end how
  from p left join found on p.o_orderstatus = 'O' and p.address = found.address),
fresh as (
  select p.*, cast(r.ord as varchar) customer_id, case when c_custkey % 4 = 0 then null else cast(s_suppkey as varchar) end vendor_id,
    case when c_custkey % 4 = 0 then vendor_text else s_name end vendor_name,
    case when o_orderstatus = 'F' then 'Purchase' else 'Bill' end txn_type
  from p join resolved r using (message_id) left join hit using (message_id) where total > 0 and hit.k is null)"""
add("post_bills", ORDERS, POSTABLE, """
  select message_id, txn_type, vendor_id, vendor_name, customer_id, iso txn_date, iso due_date, number doc_number
  from fresh where txn_type = 'Bill'""")
add("post_purchases", ORDERS, POSTABLE, """
  select message_id, txn_type, 'CreditCard' payment_type, vendor_id, vendor_name, customer_id, iso txn_date,
    (select cast(min(n_nationkey) as varchar) from nation where n_regionkey in (1, 2)) bank_account_id
  from fresh where txn_type = 'Purchase'""")
add("post_rejected", ORDERS, POSTABLE, """
  select message_id, 'total_amount missing or not positive' reason from p where coalesce(total, 0) <= 0
  union all select message_id, 'duplicate of b' || k from hit""")
add("resolve_customers", ORDERS, POSTABLE, """
  select message_id, cast(ord as varchar) customer_id, c_name resolved_customer, how customer_match
  from resolved left join customer on ord = c_custkey""")
add("ledger_posted", ORDERS, POSTABLE, LINES, RULES, """all_lines as (
  select message_id, account_id, cast(rate * quantity as decimal(18,4)) amount from lines join category_map using (category)
  union all
  select cast(l_orderkey as varchar), '31', cast(cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))) as double) as decimal(18,4)) tax
    from lineitem group by 1 having tax > 0)""", """
  select txn_type, account_id, customer_id, count(*) n_lines, cast(sum(amount) as decimal(18,4)) amount
  from all_lines join fresh using (message_id) group by 1, 2, 3""")
add("bill_header", ORDERS, DRAFTS, "select message_id, iso_date txn_date, iso_due due_date, nullif(invoice_number, '') doc_number from drafts")
add("shipment_items_text", SHIPMENTS, """
  select message_id, 'pallet (qty: ' || cast(o_totalprice as varchar) || ') [12 lb]' || chr(10) || 'box' || chr(10)
    || o_orderpriority || ' (qty: 3.0)' items_text from s""")
add("bullets_text", NOTES, """
  select message_id, '* ' || replace(summary, chr(10), chr(10) || '* ') actions,
    case when role = 'user' then '* 03/15/2026 - visit' end dates from n""")
add("classifier_context", f"""
  select doc_id, source || case lang when 'en' then chr(10) || chr(10) || 'Attachments found:' || chr(10) || '- ' || {_DOC_NAME}
      || chr(10) || '- scan.png' || chr(10)
    when 'fr' then chr(10) || chr(10) || 'Attachments found:' || chr(10) || '- scan.png' || chr(10) else '' end context
  from documents""")
add("extractor_context", f"""
  select doc_id, source || case when lang in ('en', 'fr') then chr(10) || chr(10) || 'Attachment contents:' || chr(10)
      || case when lang = 'en' then chr(10) || '--- ' || {_DOC_NAME} || ' ---' || chr(10) || text || chr(10) else '' end
      || chr(10) || '--- scan.png (binary file) ---' || chr(10) else '' end context
  from documents""")

# --- scalar functions ---------------------------------------------------------------------------------------

add("normalize_date", ORDERS, DRAFTS, "select message_id, iso_date invoice_date, iso_due due_date from drafts")
add("receipt_date", ORDERS, DRAFTS, """
  select message_id, case when priority = '3-MEDIUM' then '2026-01-01' else iso_date end invoice_date,
    case when priority = '3-MEDIUM' then '2026-01-01' else iso_due end due_date from drafts""")
add("mime_type", ORDERS, DRAFTS, """
  select filename, case priority when '1-URGENT' then 'application/pdf' when '2-HIGH' then 'image/jpeg'
    when '3-MEDIUM' then 'image/png' else 'application/octet-stream' end content_type from drafts""")
add("label_category", MAIL, f"""
  select message_id, case when has_attachment then {_CATEGORY.format('label')} else subject end category from mail""")
add("line_description", LINES, """
  select message_id, item || ' - Qty: ' || cast(quantity as varchar) || ' @$' || cast(l_extendedprice as varchar) description from lines""")
add("truncate_2000", """
  select doc_id, left(nullif(text, ''), 2000) rich_text, left(coalesce(nullif(text, ''), 'Invoice'), 2000) title from documents""")
add("email_link", ORDERS, DRAFTS, """
  select message_id, case when priority <> '5-LOW' then 'https://outlook.office365.com/mail/id/' || message_id end link from drafts""")
add("file_property", ORDERS, DRAFTS, """
  select message_id, case when priority <> '5-LOW' then filename end file_name,
    case when priority <> '5-LOW' then 'https://files.example.com/attachments/' || filename end file_url from drafts""")
add("tracking_link", SHIPMENTS, f"select message_id, {_LINK} link from s")
add("shipment_title", SHIPMENTS, """
  select message_id, case when carrier <> 'DHL' then carrier || ' - ' ||
      case when tracking_number <> '' then tracking_number else order_number end
    when tracking_number <> '' then tracking_number else 'Shipment' end title from s""")
add("delivery_status", SHIPMENTS, f"select message_id, {_STATUS} status from s")
add("carrier_option", SHIPMENTS, f"select message_id, case when carrier <> 'UPS' then {_CARRIER} end carrier from s")
add("urgency_option", NOTES, "select message_id, case role when 'user' then 'High' when 'assistant' then 'Medium' end urgency from n")
add("title_fallbacks", NOTES, "select message_id, coalesce(nullif(subject, ''), mail_subject, 'Client Communication') title from n")
add("property_values", NOTES, """
  select message_id, role = 'user' checked, nullif(subject, '') as option,
    case when role = 'user' then '2026-03-15' end starts from n""")
add("html_to_text", f"select page_id, {_html_text('html')} as text from pages")
add("decode_base64url", "select doc_id, nullif(text, '') as text from documents")
add("format_address", """
  select cast(c_custkey as varchar) customer_id, case when c_mktsegment <> 'FURNITURE' then c_mktsegment || ', ' || n_name end line,
    case when c_mktsegment <> 'FURNITURE' then lower(c_mktsegment || '  ' || n_name) else '  ' end as key
  from customer join nation on c_nationkey = n_nationkey""")
add("round2", "select o_orderkey, round(o_totalprice / 3, 2) third from orders")
add("line_amount", LINES, "select message_id, item, case when quantity > 10 then rate * quantity else rate end amount from lines")

# --- fuzzy matching: the longest common block, then the same left and right of it -----------------------------

ALTERED = """case p_size % 4 when 0 then p_name || ' Inc' when 1 then 'x' || substr(p_name, 3)
  when 2 then array_to_string(list_reverse(string_split(p_name, ' ')), ' ') else p_name || ' ' || p_brand end"""
# Longest substring of x found in y, the first one on ties: {k: size, i: start}.
_BLOCK = """coalesce(list_filter(flatten(list_transform(range(length(x), 0, -1), lambda k:
  list_transform(range(1, length(x) - k + 2), lambda i: {'k': k, 'i': i}))),
  lambda c: contains(y, substr(x, c.i, c.k)))[1], {'k': 0::bigint, 'i': 0::bigint})"""
# Needs a relation pairs(a, b); gives ratios(a, b, ratio).
RATIO = f"""seg(a, b, x, y) as (
  select a, b, a, b from pairs
  union all
  select a, b, p.x, p.y from (
    select a, b, unnest([
      {{'x': substr(x, 1, m.i - 1), 'y': substr(y, 1, strpos(y, substr(x, m.i, m.k)) - 1)}},
      {{'x': substr(x, m.i + m.k), 'y': substr(y, strpos(y, substr(x, m.i, m.k)) + m.k)}}]) p
    from (select a, b, x, y, {_BLOCK} m from seg) where m.k > 0)
  where p.x <> '' and p.y <> ''),
ratios as (
  select a, b, 2.0::double * coalesce(sum(m.k), 0) / any_value(length(a) + length(b)) ratio
  from (select a, b, {_BLOCK} m from seg) group by a, b)"""


def _fuzzy(name: str, threshold: float, column: str, master: str, lowered: bool) -> None:
    probe, target = ("lower(trim(probe))", "lower(master_name)") if lowered else ("probe", "master_name")
    ORACLES[name] = f"""with recursive masters as (
      select min(p_partkey) ord, p_name n, {'upper(p_name)' if lowered else 'p_name'} master_name from part group by p_name),
    probes as (select distinct {ALTERED} probe from part),
    pairs as (select distinct {probe} a, {target} b from probes join masters
      on least(length({probe}), length({target})) * (2 - {threshold}) > greatest(length({probe}), length({target})) * {threshold} - 1e-9),
    {RATIO},
    best as (select p.probe, m.ord, m.master_name, r.ratio from probes p join ratios r on r.a = {probe.replace('probe', 'p.probe')}
      join masters m on {target.replace('master_name', 'm.master_name')} = r.b where r.ratio > {threshold}
      qualify row_number() over (partition by p.probe order by r.ratio desc, m.ord) = 1)
    select probe as {column}, cast(ord as varchar) {master}_id, master_name {master}_name, round(ratio, 6) ratio from best"""


_fuzzy("vendor_fuzzy", 0.8, "name", "vendor", False)
_fuzzy("customer_fuzzy", 0.7, "address", "customer", True)
ORACLES["similarity"] = f"""with recursive pairs as (select distinct {ALTERED} a, p_name b from part),
    {RATIO} select a, b, round(ratio, 6) ratio from ratios"""
ORACLES["register_vendors"] = f"""with fuzzy as ({ORACLES['vendor_fuzzy']})
    select distinct {ALTERED} display_name from part
    where {ALTERED} not in (select p_name from part) and {ALTERED} not in (select name from fuzzy)"""

# --- models ------------------------------------------------------------------------------------------------------

TURNS = """m as (select 'c-' || conv_id || '-' || turn message_id, text from conversations
  union all select 'd' || doc_id, text from documents)"""
# The label of a text by the first row whose phrases it holds as whole words.
_LABELS = {
    "none": "unsubscribe|newsletter|digest|click here|[0-9]+% off|huge sale",
    "insurance": "insurance|policy|coverage|liability|adjuster|workers comp|workers compensation|claim",
    "shipping": "tracking|shipped|shipment|delivered|delivery|freight|courier|carrier|en route",
    "invoice": "invoice|receipt|bill|payment is due|remit|amount due|paid",
    "client_communications":
        "project|schedule|meeting|update|walkthrough|let me know|question|confirm|can we|status",
}
_CASES = " ".join(
    f"when regexp_matches(lower(text), '(^|[^a-z0-9])({phrases})([^a-z0-9]|$)') then '{label}'"
    for label, phrases in _LABELS.items()
)
add("classify_messages", TURNS, f"""
  select message_id, case when regexp_matches(lower(text), '(created|updated)(/updated)? an? [$]?[0-9.,x]* ?invoice') then 'none' {_CASES}
    when contains(text, '?') then 'client_communications' else 'none' end label from m""")
add("classify_with_model", TURNS, """
  select message_id, case length(text) % 3 when 0 then 'invoice' when 1 then 'shipping' end label from m""")
add("extract_invoice", ORDERS, """
  select cast(o_orderkey as varchar) message_id, c_name vendor_display_name, 'INV-' || o_orderkey invoice_number,
    strftime(o_orderdate, '%m/%d/%Y') invoice_date, 7.25::double tax, o_totalprice total_amount,
    o_orderstatus = 'F' is_receipt, 2 n_lines,
    cast(2 * o_totalprice + 12.5 * c_nationkey + 7.25 as decimal(18,4)) computed_total
  from o where c_nationkey > 0""")
add("quarantine_invoices", ORDERS, """
  select cast(o_orderkey as varchar) message_id, 'quantity must be greater than 0' errors from o where c_nationkey = 0""")
add("extract_shipping", SHIPMENTS, """
  select message_id, case carrier when 'ABC Freight' then 'Freight' else carrier end carrier,
    nullif(tracking_number, '') tracking_number, order_number, shipped_text shipment_date,
    estimated_text estimated_delivery, case delivery_status when 'Delivered' then 'delivered' else 'shipped' end delivery_status,
    'Warehouse 9' origin_address, 'Site 4' destination_address, true has_reference from s""")
add("extract_client_note", TURNS, r"""f as (
  select message_id, text, trim(regexp_replace(text, '\s+', ' ', 'g')) flat from m)""", r"""
  select message_id, case when trim(regexp_extract(flat, '^((?:[^.!?]*[.!?]+ ?){1,3})', 1)) = '' then flat
      else trim(regexp_extract(flat, '^((?:[^.!?]*[.!?]+ ?){1,3})', 1)) end summary,
    contains(text, '?') or regexp_matches(text, '(?i)\b(let me know|please (reply|confirm|respond))\b') response_needed,
    case when regexp_matches(text, '(?i)\b(urgent|asap|immediately|emergency|today)\b') then 'high'
      when regexp_matches(text, '(?i)\b(soon|this week|tomorrow|deadline|by (monday|tuesday|wednesday|thursday|friday))\b')
        or contains(text, '?') or regexp_matches(text, '(?i)\b(let me know|please (reply|confirm|respond))\b') then 'medium'
      else 'low' end urgency,
    len(regexp_extract_all(text, '(?im)^(?:- |\* |todo: )(.+)$', 1))::int n_actions
  from f""")

# --- streaming -------------------------------------------------------------------------------------------------------

add("stream_ingest", "select cast(event_id as varchar) message_id, ts received_at, event_type subject from events")
add("stream_dedup", "select distinct cast(user_id as varchar) message_id from events")
add("stream_dedup_bounded", "select distinct cast(user_id as varchar) message_id from events")
add("stream_posting", ORDERS, POSTABLE, """
  select message_id, case when o_orderkey % 3 = 0 then 'shipping' else 'invoice' end label,
    case when o_orderkey % 3 = 0 then 'shipping' when o_orderpriority = '1-URGENT' then 'no_valid_data' else 'invoice' end route,
    o_orderkey % 3 <> 0 and o_orderpriority <> '1-URGENT' tracked,
    o_orderkey % 3 <> 0 and o_orderpriority <> '1-URGENT' and fresh.txn_type is not null posted,
    case when o_orderkey % 3 <> 0 and o_orderpriority <> '1-URGENT' then fresh.vendor_id end vendor_id
  from p left join (select message_id, txn_type, vendor_id from fresh) fresh using (message_id)""")
add("stream_sink", MAIL, f"select message_id, {_CATEGORY.format('label')} category, {_ROUTE} route from mail")
add("stream_dup_by_batch", ORDERS, """m as (
  select a.o_orderkey k, min(b.o_orderkey) hit from o a join o b on a.o_custkey = b.o_custkey and a.o_orderdate = b.o_orderdate
    and abs(b.o_totalprice - (a.o_totalprice + case a.o_orderstatus when 'O' then 1000 else 0.004 end)) < 0.01 group by 1)""", """
  select cast(o_orderkey as varchar) message_id,
    cast(case when o_orderstatus = 'F' then least(o_orderkey, coalesce(hit, o_orderkey)) else hit end as varchar) duplicate_of,
    case when o_orderstatus = 'F' and o_orderkey <= coalesce(hit, o_orderkey) then 'number'
      when hit is not null then 'vendor_date_amount' end duplicate_rule
  from o left join m on k = o_orderkey""")
