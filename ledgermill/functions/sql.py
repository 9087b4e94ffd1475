"""The scalar rules and the invoice lines as functions of SQL.

``register(spark)`` makes them known to a session. Scalar functions have SQL bodies, which the optimizer writes into the
query, so no row goes through Python for them. ``invoice_lines`` is a table function with a partitioned table
argument: ``SELECT * FROM invoice_lines(TABLE(drafts) PARTITION BY message_id)``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from . import scalars as S
from .rules import CATEGORY_RULES, DEFAULT_ACCOUNT


def _quoted(value: str) -> str:
    """A SQL literal; everything but ASCII letters, digits and common signs is escaped by number."""
    plain = " -_/.:=?&,"
    return "'" + "".join(c if c.isalnum() and c.isascii() or c in plain else f"\\u{ord(c):04x}" for c in value) + "'"


def _choice(subject: str, choices: dict[str, str], other: str) -> str:
    return f"CASE {subject} " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in choices.items()) + f" ELSE {other} END"


_US_DATE = rf"""CASE WHEN value RLIKE r'{S._US_DATE}'
  THEN date_format(try_to_date(replace(value, ' ', ''), 'M/d/yyyy'), 'yyyy-MM-dd') END"""
_SPACE = _quoted(S.WHITESPACE)
_KEYS = ", ".join(_quoted(k) for k, _ in CATEGORY_RULES)
_ACCOUNTS = "map(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in CATEGORY_RULES) + ")"
_SUFFIX = r"lower(regexp_extract(substring_index(filename, '/', -1), r'[^.].*?(\.[^.]+)$', 1))"

#: Name, parameters, result type and body. Later bodies may use earlier functions.
FUNCTIONS: tuple[tuple[str, str, str, str], ...] = (
    ("iso_date", "value STRING", "STRING", f"CASE WHEN value <> '' THEN coalesce({_US_DATE}, value) END"),
    ("receipt_day", "value STRING, run_date STRING", "STRING", f"CASE WHEN value <> '' THEN coalesce({_US_DATE}, run_date) END"),
    ("field_text", "value STRING", "STRING", f"CASE WHEN value <> '' THEN left(value, {S.TEXT_LIMIT}) END"),
    ("number_text", "x DOUBLE", "STRING", r"""CASE WHEN NOT contains(CAST(x AS STRING), 'E') THEN CAST(x AS STRING)
        WHEN abs(x) >= 1e-4D AND abs(x) < 1e16D
          THEN regexp_replace(regexp_replace(CAST(CAST(x AS DECIMAL(38,21)) AS STRING), '0+$', ''), r'\.$', '.0')
        ELSE concat(regexp_replace(split_part(CAST(x AS STRING), 'E', 1), r'\.0$', ''),
          CASE WHEN contains(CAST(x AS STRING), 'E-') THEN 'e-' ELSE 'e+' END,
          lpad(replace(split_part(CAST(x AS STRING), 'E', 2), '-', ''),
            greatest(2, length(replace(split_part(CAST(x AS STRING), 'E', 2), '-', ''))), '0')) END"""),
    ("line_amount", "rate DOUBLE, quantity DOUBLE", "DOUBLE", "rate * coalesce(quantity, 1.0D)"),
    ("line_description", "item STRING, quantity DOUBLE, rate DOUBLE", "STRING",
     "concat(item, ' - Qty: ', number_text(quantity), ' @$', number_text(rate))"),
    ("expense_account", "category STRING", "STRING", f"""CASE WHEN coalesce(btrim(category, {_SPACE}), '') = '' THEN {_quoted(DEFAULT_ACCOUNT)}
        ELSE get(transform(array(lower(btrim(category, {_SPACE}))), c -> coalesce(try_element_at({_ACCOUNTS}, c),
          try_element_at({_ACCOUNTS}, get(filter(array({_KEYS}), k -> contains(c, k) OR contains(k, c)), 0)),
          {_quoted(DEFAULT_ACCOUNT)})), 0) END"""),
    ("mime_type_of", "filename STRING", "STRING", _choice(_SUFFIX, S.MIME_TYPES, _quoted(S.OTHER_MIME))),
    ("label_category", "label STRING", "STRING", _choice("label", S.CATEGORIES, "label")),
    ("carrier_option", "carrier STRING", "STRING", f"CASE WHEN carrier <> '' THEN {_choice('lower(carrier)', S.CARRIERS, _quoted('Other'))} END"),
    ("delivery_status", "status STRING", "STRING", _choice("lower(status)", S.STATUSES, _quoted("Unknown"))),
    ("urgency_option", "urgency STRING", "STRING", _choice("lower(urgency)", S.URGENCY, "NULL")),
    ("email_link", "message_id STRING", "STRING", f"CASE WHEN message_id <> '' THEN concat({_quoted(S.MAIL_LINK_PREFIX)}, message_id) END"),
    ("tracking_link", "carrier STRING, number STRING", "STRING",
     f"CASE WHEN lower(carrier) IN ({', '.join(map(_quoted, S.TRACKED_CARRIERS))}) AND number <> '' "
     f"THEN concat({_quoted(S.TRACKING_LINK)}, number, '&express=', lower(carrier)) END"),
    ("shipment_title", "carrier STRING, tracking STRING, order_number STRING", "STRING",
     f"left(coalesce(nullif(concat_ws(' - ', nullif(carrier, ''), coalesce(nullif(tracking, ''), nullif(order_number, ''))), ''), 'Shipment'), {S.TEXT_LIMIT})"),
    ("money_text", "amount DOUBLE", "DOUBLE", "round(amount, 2)"),
)


@udtf(returnType="message_id string, pos int, is_tax boolean, item string, rate double, quantity double, category string")
class InvoiceLines:
    """Lines of drafts (message_id, line_items, tax), the tax last; a missing quantity is 1."""

    def eval(self, draft: Row) -> Iterator[tuple]:
        lines = draft["line_items"] or []
        for pos, line in enumerate(lines):
            quantity = 1.0 if line["quantity"] is None else line["quantity"]
            yield draft["message_id"], pos, False, line["item"], line["rate"], quantity, line["category"]
        if draft["line_items"] is not None and draft["tax"] is not None and draft["tax"] > 0:
            yield draft["message_id"], len(lines), True, "Tax", draft["tax"], 1.0, None


def register(spark: SparkSession) -> None:
    """Make all functions known to the session under their names."""
    for name, parameters, returns, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
    spark.udtf.register("invoice_lines", InvoiceLines)
