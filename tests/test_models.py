"""Model answers: failures and malformed answers reach quarantine with their own reason only."""

from ledgermill.operators import models as M

REQUIRED = ["vendor_display_name is required", "line_items is required"]


def reasons(parse, spark, *answers):
    rows = spark.createDataFrame(list(enumerate(answers)), "message_id string, answer string")
    return [r.errors for r in parse(rows).orderBy("message_id").collect()]


def test_malformed_answers_are_rejected(spark):
    bad = ["answer is not the expected JSON"]
    assert reasons(M.parse_shipments, spark, "not json", None, "[1]", '{"carrier": "UPS"}') == [bad, ["no answer"], bad, []]
    assert reasons(M.parse_invoices, spark, "not json", None, "{}") == [bad, ["no answer"], REQUIRED]
    assert reasons(M.parse_invoices, spark, '{"vendor_display_name": "v", "line_items": [{"item": "a", "rate": "x"}]}') == [bad]
    assert reasons(M.parse_client_notes, spark, "not json", '{"summary": "x", "urgency": "now"}') == [bad, ["urgency must be low, medium or high"]]


def test_model_failures_keep_their_message(spark):
    def failing_model():
        def model(text, instructions):
            if text == "boom":
                raise RuntimeError("rate limit")
            return '{"label": "invoice"}' if text == "good" else '{"label": "spam"}'

        return model

    mail = spark.createDataFrame([("1", "boom"), ("2", "good"), ("3", "other")], "message_id string, text string")
    got = {r.message_id: r.errors for r in M.extract_invoices(mail, failing_model, "x").collect()}
    assert got == {"1": ["model failed: rate limit"], "2": REQUIRED, "3": REQUIRED}
    labels = M.label_answers(M.ask_model(mail, failing_model, "x")).orderBy("message_id").collect()
    assert [(r.label, r.errors) for r in labels] == [
        (None, ["model failed: rate limit"]), ("invoice", []), (None, ["answer names none of the labels"]),
    ]


def test_numbers_that_are_none_do_not_fail_the_batch(spark):
    texts = spark.createDataFrame([("1", "Vendor: V\nwork | 1.2.3 | 2 | x\nTotal: $1e\n")], "message_id string, text string")
    row = M.extract_invoices(texts).first()
    assert row.line_items[0].quantity is None and row.line_items[0].rate == 2.0


def test_amounts_beyond_any_integer(spark):
    from ledgermill.operators import duplicates as D

    drafts = spark.createDataFrame(
        [("a", "V", None, "2026-03-05", 1e300), ("b", "V", None, "2026-03-05", 3e17), ("c", "V", None, "2026-03-05", 5.0)],
        "message_id string, vendor_display_name string, invoice_number string, invoice_date string, total_amount double",
    )
    bills = spark.createDataFrame(
        [("x", 1, "V", "2026-03-05", None, 1e300), ("y", 2, "V", "2026-03-05", None, 3e17), ("z", 3, "V", "2026-03-05", None, 5.009)],
        "bill_id string, ord bigint, vendor_name string, txn_date string, doc_number string, total double",
    )
    got = {r.message_id: r.duplicate_of for r in D.duplicate_bills(drafts, bills).collect()}
    assert got == {"a": "x", "b": "y", "c": "z"}


def test_context_is_worded_by_the_caller():
    assert M.with_context("Do it.", None) == "Do it."
    assert M.with_context("Do it.", "- A", "Pick one:") == "Do it.\n\nPick one:\n- A"


def test_images_and_candidates_reach_the_model(spark):
    import json

    def make_model():
        def model(payload, instructions):
            kind = "bytes" if isinstance(payload, bytes) else "text"
            return json.dumps({"vendor_display_name": kind, "line_items": [], "memo": instructions})

        return model

    mail = spark.createDataFrame(
        [("1", "For Miller Garden, Oak Street", None), ("2", None, bytearray(b"\x89PNG")), ("3", "no one known", None)],
        "message_id string, text string, content binary",
    )
    names = ["Miller Garden", "Oak Miller"] + [f"Street {k}" for k in range(60)]
    customers = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "ord long, display_name string")
    lines = customers.selectExpr("ord", "concat('- ', display_name) as line")
    asked = M.with_candidates(mail, customers, lines, most=2)
    got = {r.message_id: r for r in M.extract_invoices(asked, make_model, "Read it.").collect()}
    assert [got[i].vendor_display_name for i in "123"] == ["text", "bytes", "text"]
    assert got["1"].memo == M.with_context("Read it.", "- Miller Garden\n- Oak Miller")
    assert got["2"].memo == got["3"].memo == "Read it."
