"""Column functions: dates, titles, links, options, money.

Each takes and returns Columns built from Spark's own functions only.
"Blank" means null or the empty string; a string of spaces is not blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0"
TEXT_LIMIT = 2000

# Links and option lists as the trackers expect them.
MAIL_LINK_PREFIX = "https://outlook.office365.com/mail/id/"
TRACKING_LINK = "https://www.trackingmore.com/track?number="
TRACKED_CARRIERS = ("fedex", "ups", "usps")
CARRIERS = {"fedex": "FedEx", "ups": "UPS", "usps": "USPS", "freight": "Freight"}
STATUSES = {"shipped": "Shipped", "in transit": "In Transit", "delivered": "Delivered"}
URGENCY = {"low": "Low", "medium": "Medium", "high": "High"}
CATEGORIES = {
    "invoice": "Invoice",
    "shipping": "Shipping",
    "insurance": "Insurance",
    "client_communications": "Client Communications",
    "none": "Uncategorized",
}
MIME_TYPES = {
    ".pdf": "application/pdf",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
}
OTHER_MIME = "application/octet-stream"


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def present(c: Column) -> Column:
    """The value, or null where it is blank."""
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.btrim(c, F.lit(WHITESPACE))


def option(c: Column, choices: dict[str, str], other: Column) -> Column:
    """Case-insensitive choice from a short fixed list."""
    picked = None
    for key, value in choices.items():
        condition = F.lower(c) == key
        picked = F.when(condition, value) if picked is None else picked.when(condition, value)
    return picked.otherwise(other)


# --- dates ---------------------------------------------------------------------

_US_DATE = r"^(1[0-2]|0?[1-9])/(3[01]|[12][0-9]|0?[1-9]| [1-9])/[0-9]{4}$"


def us_date(c: Column) -> Column:
    """MM/DD/YYYY to ISO text; null where the text is not such a date."""
    # Where the text is no such date, nothing is handed to the date parser.
    candidate = F.when(c.rlike(_US_DATE), F.replace(c, F.lit(" "), F.lit("")))
    return F.date_format(F.try_to_date(candidate, "M/d/yyyy"), "yyyy-MM-dd")


def normalize_date(c: Column) -> Column:
    """Blank to null, MM/DD/YYYY to ISO, anything else unchanged."""
    return F.when(~blank(c), F.coalesce(us_date(c), c))


def receipt_date(c: Column, run_date: Column) -> Column:
    """As ``normalize_date`` but text that is not MM/DD/YYYY becomes the run date."""
    return F.when(~blank(c), F.coalesce(us_date(c), run_date.cast("string")))


# --- text ----------------------------------------------------------------------


def truncate_text(c: Column, limit: int = TEXT_LIMIT) -> Column:
    """Blank to null, else the first ``limit`` characters (a tracker's field size)."""
    return F.when(~blank(c), F.left(c, F.lit(limit)))


def title(*choices: Column, default: str) -> Column:
    """First choice that is not blank, cut to the field size."""
    return F.left(F.coalesce(*[present(c) for c in choices], F.lit(default)), F.lit(TEXT_LIMIT))


def number_text(c: Column) -> Column:
    """A double as its shortest text, without an exponent between 1e-4 and 1e16."""
    text = c.cast("string")
    plain = F.regexp_replace(c.cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.try_to_number(F.split_part(text, F.lit("E"), F.lit(2)), F.lit("S999")).cast("int")
    scientific = F.concat(
        mantissa,
        F.when(power < 0, "e-").otherwise("e+"),
        F.when(F.abs(power) < 10, "0").otherwise(""),
        F.abs(power).cast("string"),
    )
    return (
        F.when(~text.contains("E"), text)
        .when((F.abs(c) >= 1e-4) & (F.abs(c) < 1e16), plain)
        .otherwise(scientific)
    )


def bullets(items: Column) -> Column:
    """``* x`` per element, one per line; null for a null or empty array."""
    lines = F.array_join(F.transform(items, lambda x: F.concat(F.lit("* "), x)), "\n")
    return F.when(F.size(items) > 0, lines)


def shipment_items_text(items: Column) -> Column:
    """``description (qty: q) [weight]`` per item, one per line."""

    def line(item: Column) -> Column:
        quantity = item["quantity"]
        shown = F.concat(F.lit(" (qty: "), number_text(quantity), F.lit(")"))
        weight = F.concat(F.lit(" ["), item["weight"], F.lit("]"))
        return F.concat(
            item["description"],
            F.when(quantity.isNotNull() & (quantity != 0), shown).otherwise(""),
            F.when(~blank(item["weight"]), weight).otherwise(""),
        )

    return F.when(F.size(items) > 0, F.array_join(F.transform(items, line), "\n"))


def line_description(item: Column, quantity: Column, rate: Column) -> Column:
    return F.concat(
        item, F.lit(" - Qty: "), number_text(quantity), F.lit(" @$"), number_text(rate)
    )


def address_line(*parts: Column) -> Column:
    """Parts that are not blank, joined with commas; null if there is none."""
    return present(F.concat_ws(", ", *[present(p) for p in parts]))


def address_key(*parts: Column) -> Column:
    """All parts lower-cased and joined with single spaces, gaps kept."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


# --- links and files -------------------------------------------------------------


def email_link(message_id: Column, prefix: str = MAIL_LINK_PREFIX) -> Column:
    return F.when(~blank(message_id), F.concat(F.lit(prefix), message_id))


def tracking_link(carrier: Column, tracking_number: Column) -> Column:
    known = F.lower(carrier).isin(*TRACKED_CARRIERS)
    url = F.concat(F.lit(TRACKING_LINK), tracking_number, F.lit("&express="), F.lower(carrier))
    return F.when(known & ~blank(tracking_number), url)


def file_url(filename: Column, base_url: str) -> Column:
    return F.when(~blank(filename), F.concat(F.lit(base_url), filename))


def file_property(url: Column) -> Column:
    """Name and address of an external file; null for a blank address."""
    name = F.substring_index(url, "/", -1)
    return F.when(~blank(url), F.struct(name.alias("name"), url.alias("url")))


def file_suffix(filename: Column) -> Column:
    """Lower-cased suffix with its dot; a leading dot alone is no suffix."""
    base = F.substring_index(filename, "/", -1)
    return F.lower(F.regexp_extract(base, r"[^.].*?(\.[^.]+)$", 1))


def mime_type(filename: Column) -> Column:
    suffix = file_suffix(filename)
    picked = F.when(suffix == ".pdf", MIME_TYPES[".pdf"])
    for key in (".jpg", ".jpeg", ".png"):
        picked = picked.when(suffix == key, MIME_TYPES[key])
    return picked.otherwise(OTHER_MIME)


# --- options ---------------------------------------------------------------------


def label_category(label: Column) -> Column:
    """Display category of a label; unknown labels pass through."""
    picked = None
    for key, value in CATEGORIES.items():
        picked = F.when(label == key, value) if picked is None else picked.when(label == key, value)
    return picked.otherwise(label)


def carrier_option(carrier: Column) -> Column:
    return F.when(~blank(carrier), option(carrier, CARRIERS, F.lit("Other")))


def delivery_status(status: Column) -> Column:
    return option(status, STATUSES, F.lit("Unknown"))


def urgency_option(urgency: Column) -> Column:
    return option(urgency, URGENCY, F.lit(None).cast("string"))


def shipment_title(carrier: Column, tracking_number: Column, order_number: Column) -> Column:
    reference = F.coalesce(present(tracking_number), present(order_number))
    joined = F.concat_ws(" - ", present(carrier), reference)
    return title(joined, default="Shipment")


def checkbox(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def select_option(c: Column) -> Column:
    return present(c)


def date_start(c: Column) -> Column:
    return normalize_date(c)


# --- money -----------------------------------------------------------------------


def line_amount(rate: Column, quantity: Column) -> Column:
    return rate * F.coalesce(quantity, F.lit(1.0))


def items_total(line_items: Column, tax: Column) -> Column:
    """Sum of rate times quantity over a draft's lines, plus tax."""
    lines = F.aggregate(
        line_items,
        F.lit(0.0),
        lambda total, line: total + line_amount(line["rate"], line["quantity"]),
    )
    return lines + F.coalesce(tax, F.lit(0.0))


def round2(c: Column) -> Column:
    """Two decimals, ties away from zero, for display only."""
    return F.round(c, 2)
