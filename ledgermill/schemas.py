"""Fixed schemas of the tables the operators read and write (Spark DDL)."""

LINE = "struct<item:string,rate:double,quantity:double,description:string,category:string>"

MESSAGES = (
    "message_id string, subject string, body_type string, body string, "
    "received_at timestamp, has_attachments boolean, "
    "attachments array<struct<name:string,content_b64:string,is_inline:boolean>>"
)

# What an invoice extractor must return, as JSON.
INVOICE_PAYLOAD = (
    f"vendor_display_name string, memo string, line_items array<{LINE}>, tax double, "
    "total_amount double, due_date string, invoice_number string, invoice_date string, "
    "is_receipt boolean, job_site_address string, customer_name string"
)
DRAFTS = (
    "message_id string, vendor_display_name string, vendor_company_name string, "
    f"line_items array<{LINE}>, memo string, tax double, total_amount double, "
    "due_date string, invoice_number string, invoice_date string, is_receipt boolean, "
    "job_site_address string, customer_name string"
)
SHIPPING_PAYLOAD = (
    "carrier string, tracking_number string, order_number string, shipment_date string, "
    "estimated_delivery string, delivery_status string, origin_address string, "
    "destination_address string, "
    "items array<struct<description:string,quantity:double,weight:string>>, "
    "vendor_name string, notes string"
)
CLIENT_PAYLOAD = (
    "client_name string, subject string, project_name string, summary string, "
    "action_items array<string>, key_dates array<string>, response_needed boolean, "
    "urgency string, notes string"
)
ADDRESS = "struct<line1:string,line2:string,city:string>"
CUSTOMERS = (
    f"customer_id string, ord bigint, display_name string, bill_addr {ADDRESS}, ship_addr {ADDRESS}"
)
VENDORS = "vendor_id string, ord bigint, display_name string"
ACCOUNTS = "account_id string, ord bigint, name string, account_type string"
PROCESSED = "message_id string"

# One node of a mail part tree. Children stay raw JSON text, so the tree can be
# opened one level at a time although Spark has no recursive types.
MIME_NODE = (
    "filename string, mimeType string, "
    "headers array<struct<name:string,value:string>>, "
    "body struct<data:string,attachmentId:string,size:bigint>, parts array<string>"
)

LABELS = ("invoice", "shipping", "insurance", "client_communications", "none")
URGENCIES = ("low", "medium", "high")
TXN_TYPES = ("Bill", "Purchase", "Deposit", "Payment", "BillPayment")
