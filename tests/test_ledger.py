import json

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import duplicates as D
from ledgermill.operators import ledger as L
from ledgermill.operators import models as M
from ledgermill.operators import trackers as K
from ledgermill.schemas import DRAFTS, SHIPPING_PAYLOAD

ACCOUNTS = "account_id string, ord bigint, name string, account_type string"


def draft(mid, lines, total, tax=None, receipt=False, day=None, number=None):
    rows = [(i, r, q, None, c) for i, r, q, c in lines]
    return (mid, "Acme", None, rows, None, tax, total, None, number, day, receipt, None, None)


@pytest.fixture(scope="module")
def drafts(spark):
    return spark.createDataFrame(
        [
            draft("b1", [("work", 50.0, 8.0, "Labor"), ("stone", 100.0, 5.0, "Materials")], 900.0, 0.0, day="03/15/2026", number="N1"),
            draft("b2", [("one", 100.0, None, "odd")], 110.0, 10.0, day="", number=""),
            draft("r1", [("a", 15.0, 10.0, "Fuel"), ("b", 25.0, 1.0, None)], 175.0, None, True, "not a date"),
            draft("x1", [("a", 1.0, 1.0, None)], None),
            draft("x2", [("a", 1.0, 1.0, None)], 0.0),
            draft("x3", [("a", 1.0, 1.0, None)], -1.0),
        ],
        DRAFTS,
    )


def test_lines(drafts):
    lines = L.ledger_lines(L.explode_lines(drafts, ["message_id"]), ["message_id", "pos"])
    got = {(r.message_id, r.pos): (r.amount, r.account_id, r.description) for r in lines.collect()}
    assert got[("b1", 0)] == (400.0, "59", "work - Qty: 8.0 @$50.0")
    assert got[("b1", 1)] == (500.0, "63", "stone - Qty: 5.0 @$100.0")
    assert got[("b2", 0)] == (100.0, "31", "one - Qty: 1.0 @$100.0")
    assert got[("b2", 1)] == (10.0, "31", "Tax")
    assert ("b1", 2) not in got and ("r1", 2) not in got
    assert [r.amount for r in L.tax_lines(drafts, ["message_id"]).collect()] == [10.0]


def test_headers(spark, drafts):
    good, bad = L.split_by_total(drafts)
    assert {r.message_id for r in bad.collect()} == {"x1", "x2", "x3"}
    bills = {r.message_id: r for r in L.build_bills(good.filter("not is_receipt")).collect()}
    assert (bills["b1"].txn_date, bills["b1"].doc_number) == ("2026-03-15", "N1")
    assert bills["b2"].txn_date is None and bills["b2"].doc_number is None
    accounts = spark.createDataFrame([("9", 2, "Card", "Credit Card"), ("8", 1, "Sales", "Income")], ACCOUNTS)
    receipts = good.filter("is_receipt")
    purchase = L.build_purchases(receipts, accounts, "2026-01-01").collect()
    assert [(p.bank_account_id, p.payment_type, p.txn_date) for p in purchase] == [("9", "CreditCard", "2026-01-01")]
    none = accounts.filter("account_type = 'Bank'")
    assert L.build_purchases(receipts, none, "2026-01-01").count() == 0
    assert L.unpayable(receipts, none).count() == 1 and L.unpayable(receipts, accounts).count() == 0


def test_check_totals(drafts):
    got = {r.message_id: (r.mismatch, r.total_amount) for r in L.check_totals(drafts).collect()}
    assert got["b1"] == (False, 900.0) and got["x1"] == (False, 1.0) and got["x2"] == (True, 0.0)


def test_duplicates(spark):
    bills = spark.createDataFrame(
        [("1", 1, "V", "2026-03-05", "A", 150.0), ("2", 2, "V", "2026-03-05", "B", 150.0), ("3", 3, "W", None, None, 100.0), ("4", 4, "W", "x", "", 7.0)],
        "bill_id string, ord bigint, vendor_name string, txn_date string, doc_number string, total double",
    )
    drafts = spark.createDataFrame(
        [
            ("number", "Z", "A", "1/1/2020", 5.0), ("amount", "V", "other", "3/5/2026", 150.0), ("earlier", "V", "B", "03/05/2026", 150.004),
            ("band", "V", None, "2026-03-05", 150.02), ("double", "V", None, "2026-03-05", 150.01), ("nulls", "W", "", None, 100.0), ("none", "W", None, "2026-03-05", 100.0),
            ("nototal", "V", "", "2026-03-05", None), ("200", "V", "", "2026-03-05", 200.0),
        ],
        "message_id string, vendor_display_name string, invoice_number string, invoice_date string, total_amount double",
    )
    got = {r.message_id: (r.duplicate_of, r.duplicate_rule) for r in D.duplicate_bills(drafts, bills).collect()}
    amount = "vendor_date_amount"
    assert got == {
        "number": ("1", "number"), "amount": ("1", amount), "earlier": ("1", amount), "band": (None, None),
        # 150.01 - 150.0 is below 0.01 in doubles.
        "double": ("1", amount), "nulls": ("3", amount), "none": (None, None), "nototal": (None, None), "200": (None, None),
    }


def test_amount_band_equals_brute_force(spark):
    bills = [(str(i), i, "V", "d", 100 + i * 0.0037) for i in range(60)]
    probes = [("V", "d", 100 + j * 0.0021) for j in range(100)]
    got = D.amount_matches(
        spark.createDataFrame(probes, "vendor string, date string, total double"),
        spark.createDataFrame(bills, "bill_id string, ord bigint, vendor_name string, txn_date string, total double"),
    ).collect()
    want = {t: min(b[1] for b in bills if abs(b[4] - t) < 0.01) for _, _, t in probes if any(abs(b[4] - t) < 0.01 for b in bills)}
    assert {r.total: r.amt_ord for r in got} == want


def test_audits(spark):
    txns = spark.createDataFrame(
        [("Bill", "1", "A", 5.0, "d"), ("Bill", "2", "A", 5.0, "d"), ("Bill", "3", "B", 5.0, "d"), ("Bill", "4", None, 1.0, None),
         ("Bill", "5", "Unknown", 1.0, None), ("Deposit", "6", None, 2.0, "d"), ("Deposit", "7", "x", 2.0, "d"), ("Payment", "8", "p", 1.0, "d")],
        "txn_type string, txn_id string, party string, total_amt double, txn_date string",
    )
    hard = {(r.party, r.n) for r in D.duplicate_groups(txns, "Bill", True).collect()}
    assert hard == {("A", 2), ("Unknown", 2)}
    soft = {(r.total_amt, r.n, r.first_id, r.last_id) for r in D.duplicate_groups(txns, "Bill", False).collect()}
    assert soft == {(5.0, 3, "1", "3"), (1.0, 2, "4", "5")}
    members = {r.txn_id for r in D.duplicate_members(txns, True).collect()}
    # Deposits are grouped by amount and date whoever paid them in.
    assert members == {"1", "2", "4", "5", "6", "7"}
    summary = {(r.txn_type, r.strictness): r.n_groups for r in D.duplicate_summary(txns).collect()}
    assert summary == {("Bill", "hard"): 2, ("Bill", "soft"): 2, ("Deposit", "soft"): 1, ("Payment", "hard"): 0, ("Payment", "soft"): 0}


def test_tracker_dedup(spark):
    tracker = spark.createDataFrame([("N1",), ("",), (None,)], "po_number string")
    drafts = spark.createDataFrame([("1", 1, "N1"), ("2", 3, "N2"), ("3", 2, "N2"), ("4", 4, ""), ("5", 5, None)], "message_id string, arrival int, invoice_number string")
    assert {r.message_id for r in D.new_to_tracker(drafts, tracker).collect()} == {"3", "4", "5"}
    assert {r.message_id for r in D.tracker_exists(drafts, tracker).filter("exists").collect()} == {"1"}


def test_models(spark):
    answers = {
        "ok": {"vendor_display_name": "V", "line_items": [{"item": "a", "rate": 2.0}], "is_receipt": None},
        "quantity": {"vendor_display_name": "V", "line_items": [{"item": "a", "rate": 2.0, "quantity": 0}]},
        "vendor": {"line_items": []},
    }
    rows = [(k, json.dumps(v)) for k, v in answers.items()] + [("none", None), ("broken", "{")]
    parsed = M.parse_invoices(spark.createDataFrame(rows, "message_id string, answer string"))
    good = M.to_drafts(M.accepted(parsed)).collect()
    assert [(r.message_id, r.line_items[0].quantity, r.is_receipt) for r in good] == [("ok", 1.0, False)]
    assert {r.message_id for r in M.quarantined(parsed).collect()} == {"quantity", "vendor", "none", "broken"}
    notes = spark.createDataFrame([("a", '{"summary": "s"}'), ("b", '{"summary": "s", "urgency": "critical"}'), ("c", "{}")], "message_id string, answer string")
    assert [r.message_id for r in M.accepted(M.parse_client_notes(notes)).collect()] == ["a"]
    ships = spark.createDataFrame([("a", '{"carrier": "FedEx"}'), ("b", "{}")], "message_id string, answer string")
    assert {r.message_id: r.has_reference for r in M.parse_shipments(ships).collect()} == {"a": True, "b": False}


SENTENCES = {
    "Our bill for March is enclosed, see invoice 77.": "invoice",
    "The amount due on the Miller job is $310.20; kindly remit soon.": "invoice",
    "Good news: parcel shipped today, tracking 1Z0000000001.": "shipping",
    "The crate has been delivered to the side gate.": "shipping",
    "Courier note: pallet is en route to your yard.": "shipping",
    "New certificate of insurance with liability limits enclosed.": "insurance",
    "Your workers comp claim is with an adjuster now.": "insurance",
    "The fleet policy expires in April.": "insurance",
    "Short update: the kitchen cabinets go in on Monday.": "client_communications",
    "Could we set a walkthrough for Thursday? Let me know.": "client_communications",
    "Which tile is it for the bathroom?": "client_communications",
    "Only today 40% off every saw, click here!": "none",
    "The monthly trade newsletter is out.": "none",
    "Someone created/updated a $500 invoice": "none",
    "Overpaidness is not a word here": "none",
    "": "none",
}


def test_classifier_rules(spark):
    rows = spark.createDataFrame([(t, t) for t in SENTENCES], "message_id string, text string")
    assert {r.message_id: r.label for r in M.classify_messages(rows).collect()} == SENTENCES


def test_model_hook(spark):
    def make_model():
        import json as j

        def model(text, instructions):
            if text == "boom":
                raise ValueError("no answer")
            return j.dumps({"label": "shipping" if instructions == "go" and text == "a" else "spam"})

        return model

    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "boom")], "message_id string, text string")
    got = {r.message_id: r.label for r in M.classify_messages(rows, make_model, "go").collect()}
    assert got == {"1": "shipping", "2": None, "3": None}
    errors = {r.message_id: r.error for r in M.ask_model(rows, make_model, "go").collect()}
    assert errors == {"1": None, "2": None, "3": "no answer"}
    assert M.with_context("x", None) == "x" and "- Oak" in M.with_context("x", "- Oak: 1 Oak")


def test_trackers(spark):
    shipment = spark.createDataFrame(
        [("m", "DHL Express", "T1", None, "03/15/2026", None, "in transit", None, None, [], "V", None)], "message_id string, " + SHIPPING_PAYLOAD
    )
    row = K.shipping_tracker(shipment).first()
    assert (row.name, row.status, row.carrier, row.date, row.tracking_link) == ("DHL Express - T1", "In Transit", "Other", "2026-03-15", None)
    labels = spark.createDataFrame([("1", "invoice", 1), ("1", "none", 2), ("2", "odd", 1)], "message_id string, label string, seq int")
    assert {r.message_id: r.categories for r in K.label_updates(labels).collect()} == {"1": ["Uncategorized"], "2": ["odd"]}
    rows = spark.createDataFrame([("invoice", True), ("invoice", False), ("insurance", False), ("none", True), (None, True)], "l string, a boolean")
    got = [r[0] for r in rows.select(K.route(F.col("l"), F.col("a"))).collect()]
    assert got == ["invoice", "no_valid_data", "insurance", "no_valid_data", "no_valid_data"]
