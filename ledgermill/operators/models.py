"""Classification and extraction through pluggable models, with validation.

A model is any callable; it runs once per partition inside ``mapInPandas`` and answers
with JSON, which is parsed and checked here. Without a model the deterministic
rules below are used; they are plain column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import blank, present, strip
from ..schemas import CLIENT_PAYLOAD, INVOICE_PAYLOAD, LABELS, SHIPPING_PAYLOAD, URGENCIES
from .joins import keyed_join

# A model factory is called once per partition and returns a function from (text or bytes, instructions)
# to a JSON string, or None when no answer could be had.
ModelFactory = Callable[[], Callable[[str | bytes, str], str | None]]


# --- the hook --------------------------------------------------------------------


def ask_model(messages: DataFrame, make_model: ModelFactory, instructions: str) -> DataFrame:
    """(message_id, answer, error): one model call per message, one client per partition.

    The model gets the message's ``text``, or the bytes in ``content`` where there are any (an image, say), and the
    instructions, followed by the message's own ``context`` where there is one; both columns are optional. An
    exception in a call becomes a null answer with its message in ``error``, so one bad message never
    fails the batch.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        model = make_model()
        for batch in batches:
            answers, errors = [], []
            for text, content, context in zip(batch["text"], batch["content"], batch["context"]):
                try:
                    payload = text if content is None else bytes(content)
                    answers.append(model(payload, with_context(instructions, context)))
                    errors.append(None)
                except Exception as problem:  # noqa: BLE001 - goes to quarantine
                    answers.append(None)
                    errors.append(str(problem))
            yield pd.DataFrame(
                {"message_id": batch["message_id"], "answer": answers, "error": errors}
            )

    schema = "message_id string, answer string, error string"
    optional = {"content": "binary", "context": "string"}
    columns = [
        F.col(c) if c in messages.columns else F.lit(None).cast(kind).alias(c) for c, kind in optional.items()
    ]
    return messages.select("message_id", "text", *columns).mapInPandas(run, schema)


#: A word of more customers than this says too little about which one is meant.
COMMON_WORD = 50


def with_candidates(messages: DataFrame, customers: DataFrame, context: DataFrame, most: int = 20) -> DataFrame:
    """Messages with ``context``: the lines of the ``most`` customers that share most rare words with the text.

    ``context`` has ord and line, one row per customer (``customers_context``). Words of more than
    ``COMMON_WORD`` customers are not looked up, so a word brings a bounded number of candidates, and a model
    never sees the whole master. A message without candidates has a null context.
    """
    split = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}#]+"), lambda w: F.length(w) > 2))
    words = customers.select("ord", F.explode(split(F.col("display_name"))).alias("word"))
    rare = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= COMMON_WORD).select("word")
    asked = messages.select("message_id", F.explode(split(F.col("text"))).alias("word"))
    met = keyed_join(keyed_join(asked, rare, ["word"], "left_semi"), words, ["word"], "inner")
    ranked = met.groupBy("message_id", "ord").agg(F.count(F.lit(1)).alias("shared"))
    order = Window.partitionBy("message_id").orderBy(F.desc("shared"), "ord")
    best = ranked.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    lines = keyed_join(best, context.select("ord", "line"), ["ord"], "inner")
    listed = lines.groupBy("message_id").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("rows"))
    listed = listed.select("message_id", F.array_join(F.col("rows.line"), "\n").alias("context"))
    return keyed_join(messages, listed, ["message_id"], "left")


# What a model is asked to do with the candidates that follow; callers may word it as they like.
CANDIDATES = "Candidate customers, one per line. Copy customer_name from this list, or leave it null:"


def with_context(instructions: str, context: str | None, request: str = CANDIDATES) -> str:
    """Instructions followed by the request and the customer list, where there is a list."""
    return f"{instructions}\n\n{request}\n{context}" if context else instructions


# --- classification ----------------------------------------------------------------

# Tried from top to bottom; the first rule with one of its phrases in the text names the
# label. Phrases must not touch further ASCII letters or digits. Notices that
# a job tool sends by itself ("created a $500 invoice") are none.
AUTOMATED = r"(?:created|updated)(?:/updated)? an? \$?[0-9.,x]* ?invoice"
LABEL_RULES = (
    ("none", ("unsubscribe", "newsletter", "digest", "click here", "[0-9]+% off", "huge sale")),
    ("insurance", ("insurance", "policy", "coverage", "liability", "adjuster", "workers comp",
                   "workers compensation", "claim")),
    ("shipping", ("tracking", "shipped", "shipment", "delivered", "delivery", "freight", "courier",
                  "carrier", "en route")),
    ("invoice", ("invoice", "receipt", "bill", "payment is due", "remit", "amount due", "paid")),
    ("client_communications", ("project", "schedule", "meeting", "update", "walkthrough", "let me know",
                               "question", "confirm", "can we", "status")),
)


def phrase_pattern(phrases: tuple[str, ...]) -> str:
    """Pattern for any of the phrases in lower-case text."""
    return f"(?:^|[^a-z0-9])(?:{'|'.join(phrases)})(?:[^a-z0-9]|$)"


def classify(text: Column) -> Column:
    """Label of a message by keyword rules that follow the category descriptions."""

    def label_of(lowered: Column) -> Column:
        # A plain substring test is far cheaper than the pattern and rules out most texts.
        label = F.when(lowered.contains("invoice") & lowered.rlike(AUTOMATED), "none")
        for name, phrases in LABEL_RULES:
            near = F.lit(False)
            for phrase in phrases:
                near = near | lowered.contains(phrase.removeprefix("[0-9]+"))
            label = label.when(near & lowered.rlike(phrase_pattern(phrases)), name)
        return label.when(lowered.contains("?"), "client_communications").otherwise("none")

    # The one-element array keeps the lower-cased text from being computed per rule.
    return F.coalesce(F.get(F.transform(F.array(F.lower(text)), label_of), F.lit(0)), F.lit("none"))


def valid_label(answer: Column) -> Column:
    """The label in a model's JSON answer, or null if it is not one of the five."""
    label = F.get_json_object(answer, "$.label")
    return F.when(label.isin(*LABELS), label)


def classify_messages(messages: DataFrame, make_model: ModelFactory | None = None, instructions: str = "") -> DataFrame:
    """(message_id, label) of messages (message_id, text); ``label_answers`` also tells why one is missing."""
    if make_model is None:
        return messages.select("message_id", classify(F.col("text")).alias("label"))
    return label_answers(ask_model(messages, make_model, instructions)).drop("errors")


def label_answers(answers: DataFrame) -> DataFrame:
    """(message_id, label, errors) of a model's answers; no valid label comes with its reason."""
    label = valid_label(F.col("answer"))
    checks = [(label.isNull(), "answer names none of the labels")]
    known = answers if "error" in answers.columns else answers.withColumn("error", F.lit(None).cast("string"))
    return known.select("message_id", label.alias("label"), _errors(checks, F.lit(False)).alias("errors"))


# --- invoices ----------------------------------------------------------------------


def _opened(answers: DataFrame, schema: str) -> DataFrame:
    """(message_id, answer, error, payload columns, _corrupt): each answer is parsed exactly once.

    ``inline`` is a generator, which the optimizer neither repeats per field nor
    moves filters through.
    """
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    payload = F.inline(F.array(F.from_json("answer", f"{schema}, _corrupt string", options)))
    error = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    return answers.select("message_id", "answer", error.alias("error"), payload)


def parse_invoices(answers: DataFrame) -> DataFrame:
    """(message_id, answer JSON) to payload columns and ``errors``.

    ``errors`` is empty for a valid payload; anything else is for quarantine.
    """
    lines = F.col("line_items")
    checks = [
        (F.col("vendor_display_name").isNull(), "vendor_display_name is required"),
        (lines.isNull(), "line_items is required"),
        (F.exists(lines, lambda x: x["item"].isNull()), "line item without item"),
        (F.exists(lines, lambda x: x["rate"].isNull()), "line item without rate"),
        (F.exists(lines, lambda x: F.coalesce(x["quantity"] <= 0, F.lit(False))), "quantity must be greater than 0"),
    ]
    return _opened(answers, INVOICE_PAYLOAD).withColumn("errors", _errors(checks)).drop("answer", "error", "_corrupt")


def _errors(checks: list[tuple[Column, str]], corrupt: Column | None = None) -> Column:
    """Why an answer cannot be used. Without a readable answer that is the only reason."""
    corrupt = F.col("_corrupt").isNotNull() if corrupt is None else corrupt
    found = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in checks]))
    return (
        F.when(F.col("error").isNotNull(), F.array(F.concat(F.lit("model failed: "), "error")))
        .when(F.col("answer").isNull(), F.array(F.lit("no answer")))
        .when(corrupt, F.array(F.lit("answer is not the expected JSON")))
        .otherwise(found)
    )


def to_drafts(payloads: DataFrame) -> DataFrame:
    """Draft columns of valid payloads; the missing quantity of a line is 1."""
    lines = F.transform(
        "line_items",
        lambda x: F.struct(
            x["item"].alias("item"),
            x["rate"].alias("rate"),
            F.coalesce(x["quantity"], F.lit(1.0)).alias("quantity"),
            x["description"].alias("description"),
            x["category"].alias("category"),
        ),
    )
    return payloads.select(
        "message_id",
        "vendor_display_name",
        F.lit(None).cast("string").alias("vendor_company_name"),
        lines.alias("line_items"),
        "memo", "tax", "total_amount", "due_date", "invoice_number", "invoice_date",
        F.coalesce("is_receipt", F.lit(False)).alias("is_receipt"),
        "job_site_address", "customer_name",
    )


# Fields a plain-text invoice states as ``Name: value`` lines.
_INVOICE_FIELDS = {
    "vendor_display_name": "Vendor",
    "invoice_number": "Invoice",
    "invoice_date": "Date",
    "due_date": "Due",
    "job_site_address": "Job site",
    "customer_name": "Customer",
    "memo": "Memo",
}


def _stated(text: Column, name: str) -> Column:
    return present(strip(F.regexp_extract(text, rf"(?im)^{name}[ \t]*:[ \t]*(.*)$", 1)))


def _stated_number(text: Column, name: str) -> Column:
    digits = F.regexp_extract(text, rf"(?im)^{name}[ \t]*:[ \t]*\$?([0-9][0-9,]*\.?[0-9]*)", 1)
    return F.replace(present(digits), F.lit(","), F.lit("")).try_cast("double")


def extract_invoice_json(text: Column) -> Column:
    """Rule-based stand-in for an invoice model: reads stated fields and item lines.

    Item lines look like ``item | quantity | rate | category``.
    """
    pattern = r"(?m)^([^|\n]+)\|[ \t]*([0-9.]+)[ \t]*\|[ \t]*\$?([0-9.]+)[ \t]*\|[ \t]*([^|\n]*)$"
    rows = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    split_rows = F.transform(rows, lambda row: F.transform(F.split(row, r"\|"), strip))

    def line(cells: Column) -> Column:
        return F.struct(
            F.get(cells, F.lit(0)).alias("item"),
            F.replace(F.get(cells, F.lit(2)), F.lit("$"), F.lit("")).try_cast("double").alias("rate"),
            F.get(cells, F.lit(1)).try_cast("double").alias("quantity"),
            present(F.get(cells, F.lit(3))).alias("category"),
        )

    fields = [_stated(text, label).alias(name) for name, label in _INVOICE_FIELDS.items()]
    return F.to_json(
        F.struct(
            *fields,
            F.transform(split_rows, line).alias("line_items"),
            _stated_number(text, "Tax").alias("tax"),
            _stated_number(text, "Total").alias("total_amount"),
            text.rlike(r"\bPAID\b|\bSOLD ON\b").alias("is_receipt"),
        )
    )


def extract_invoices(
    messages: DataFrame, make_model: ModelFactory | None = None,
    instructions: str = "",
) -> DataFrame:
    """(message_id, payload columns, errors) of invoices; see ``ask_model`` for images and customer lists."""
    if make_model is None:
        answers = messages.select("message_id", extract_invoice_json(F.col("text")).alias("answer"))
    else:
        answers = ask_model(messages, make_model, instructions)
    return parse_invoices(answers)


# --- shipments -----------------------------------------------------------------------


def shipping_required(carrier: Column, tracking_number: Column, order_number: Column) -> Column:
    """Whether at least one of the three identifying fields is there."""
    return F.coalesce(present(tracking_number), present(order_number), present(carrier)).isNotNull()


def parse_shipments(answers: DataFrame) -> DataFrame:
    """(message_id, answer JSON) to shipping columns, has_reference and errors."""
    none = F.array().cast("array<struct<description:string,quantity:double,weight:string>>")
    parsed = _opened(answers, SHIPPING_PAYLOAD).withColumn("items", F.coalesce("items", none))
    checks = [
        (F.exists("items", lambda x: x["description"].isNull()), "shipped item without description"),
    ]
    reference = shipping_required(F.col("carrier"), F.col("tracking_number"), F.col("order_number"))
    return parsed.withColumns({"has_reference": reference, "errors": _errors(checks)}).drop("answer", "error", "_corrupt")


_DATE = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"


def extract_shipment_json(text: Column) -> Column:
    """Rule-based stand-in for a shipping model."""
    carrier = F.regexp_extract(text, r"(?i)\b(fedex|ups|usps|dhl|freight)\b", 1)
    tracking = F.regexp_extract(text, r"(?i)\btracking(?: number| no\.?| #)?[:# ]+([A-Z0-9]{8,})", 1)
    order = F.regexp_extract(text, r"(?i)\border(?: number| no\.?| #)?[:# ]+([A-Z0-9-]*[0-9][A-Z0-9-]*)", 1)
    shipped = F.regexp_extract(text, rf"(?i)\bshipped(?: on)?[: ]+({_DATE})", 1)
    expected = F.regexp_extract(text, rf"(?i)\b(?:estimated|expected) delivery(?: on)?[: ]+({_DATE})", 1)
    status = (
        F.when(text.rlike(r"(?i)\b(was|been) delivered\b"), "delivered")
        .when(text.rlike(r"(?i)\b(in transit|en route)\b"), "in transit")
        .when(text.rlike(r"(?i)\bshipped\b"), "shipped")
    )
    return F.to_json(
        F.struct(
            present(carrier).alias("carrier"),
            present(tracking).alias("tracking_number"),
            present(order).alias("order_number"),
            present(shipped).alias("shipment_date"),
            present(expected).alias("estimated_delivery"),
            status.alias("delivery_status"),
            _stated(text, "From").alias("origin_address"),
            _stated(text, "To").alias("destination_address"),
            _stated(text, "Vendor").alias("vendor_name"),
        )
    )


def extract_shipments(messages: DataFrame, make_model: ModelFactory | None = None, instructions: str = "") -> DataFrame:
    if make_model is None:
        answers = messages.select("message_id", extract_shipment_json(F.col("text")).alias("answer"))
    else:
        answers = ask_model(messages, make_model, instructions)
    return parse_shipments(answers)


# --- client notes ----------------------------------------------------------------------


def parse_client_notes(answers: DataFrame) -> DataFrame:
    """(message_id, answer JSON) to client note columns and errors."""
    none = F.array().cast("array<string>")
    urgency = F.col("urgency")
    checks = [
        (F.col("summary").isNull(), "summary is required"),
        (urgency.isNotNull() & ~urgency.isin(*URGENCIES), "urgency must be low, medium or high"),
    ]
    filled = {
        "action_items": F.coalesce("action_items", none),
        "key_dates": F.coalesce("key_dates", none),
        "response_needed": F.coalesce("response_needed", F.lit(False)),
        "errors": _errors(checks),
    }
    return _opened(answers, CLIENT_PAYLOAD).withColumns(filled).drop("answer", "error", "_corrupt")


def extract_client_note_json(text: Column) -> Column:
    """Rule-based stand-in for a client note model: first three sentences, dates, urgency."""
    flat = strip(F.regexp_replace(text, r"\s+", " "))
    summary = F.regexp_extract(flat, r"^((?:[^.!?]*[.!?]+ ?){1,3})", 1)
    urgent = text.rlike(r"(?i)\b(urgent|asap|immediately|emergency|today)\b")
    soon = text.rlike(r"(?i)\b(soon|this week|tomorrow|deadline|by (monday|tuesday|wednesday|thursday|friday))\b")
    question = text.contains("?") | text.rlike(r"(?i)\b(let me know|please (reply|confirm|respond))\b")
    return F.to_json(
        F.struct(
            _stated(text, "Client").alias("client_name"),
            _stated(text, "Subject").alias("subject"),
            _stated(text, "Project").alias("project_name"),
            F.when(blank(strip(summary)), flat).otherwise(strip(summary)).alias("summary"),
            F.transform(
                F.regexp_extract_all(text, F.lit(r"(?im)^(?:- |\* |todo: )(.+)$"), F.lit(1)), strip
            ).alias("action_items"),
            F.regexp_extract_all(text, F.lit(rf"({_DATE})"), F.lit(1)).alias("key_dates"),
            question.alias("response_needed"),
            F.when(urgent, "high").when(soon | question, "medium").otherwise("low").alias("urgency"),
        )
    )


def extract_client_notes(messages: DataFrame, make_model: ModelFactory | None = None, instructions: str = "") -> DataFrame:
    if make_model is None:
        answers = messages.select("message_id", extract_client_note_json(F.col("text")).alias("answer"))
    else:
        answers = ask_model(messages, make_model, instructions)
    return parse_client_notes(answers)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("errors") == 0).drop("errors")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.size("errors") > 0)
