import json

from pyspark.sql import functions as F

from ledgermill.operators.inorder import post_in_order
from ledgermill.operators.keyed_table import KeyedTable
from ledgermill.streaming import ingest


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, rows)))


def message(i, day=1):
    return dict(message_id=str(i), subject="s", body_type="text", body="b", received_at=f"2026-01-{day:02d}T00:00:00")


def test_dedup_survives_restart(spark, tmp_path):
    inbox, out, state = tmp_path / "inbox", str(tmp_path / "out"), str(tmp_path / "state")
    drop(inbox, "1.json", [message(1), message(2), message(1)])

    def run():
        stream = ingest.dedup(ingest.message_stream(spark, str(inbox))).select("message_id", "subject")
        ingest.start(stream, out, state).awaitTermination()

    run()
    drop(inbox, "2.json", [message(2), message(3)])
    run()
    run()
    assert sorted(r.message_id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_bounded_dedup(spark, tmp_path):
    drop(tmp_path / "inbox", "1.json", [message(1), message(1), message(2)])
    stream = ingest.dedup(ingest.message_stream(spark, str(tmp_path / "inbox")), "received_at", "1 day")
    rows = ingest.drain(stream.select("message_id", "received_at"), "test")
    assert sorted(r.message_id for r in rows.collect()) == ["1", "2"]


def test_routed_sink_overwrites_a_retried_batch(spark, tmp_path):
    batch = spark.createDataFrame([("1", "invoice", True), ("2", "odd", False)], "message_id string, label string, has_attachment boolean")
    handle = ingest.routed_sink(str(tmp_path))
    handle(batch, 0)
    handle(batch, 0)
    handle(batch.withColumn("message_id", F.concat("message_id", F.lit("b"))), 1)
    rows = ingest.read_routed(spark, str(tmp_path)).collect()
    assert sorted((r.message_id, r.route, r.category, r.batch) for r in rows) == [
        ("1", "invoice", "Invoice", 0), ("1b", "invoice", "Invoice", 1),
        ("2", "no_valid_data", "odd", 0), ("2b", "no_valid_data", "odd", 1),
    ]


def test_posting_sees_earlier_batches(spark, tmp_path):
    schema = (
        "message_id string, arrival bigint, vendor_display_name string, invoice_number string, "
        "invoice_date string, total_amount double, lines_total double, is_receipt boolean"
    )
    row = lambda i, vendor, number: dict(
        message_id=f"m{i}", arrival=i, vendor_display_name=vendor, invoice_number=number,
        invoice_date="03/05/2026", total_amount=10.0 + i, lines_total=10.0 + i, is_receipt=False,
    )
    inbox, base = tmp_path / "inbox", str(tmp_path / "base")
    bills = spark.createDataFrame([], "bill_id string, ord bigint, vendor_name string, txn_date string, doc_number string, total double")
    vendors = spark.createDataFrame([], "vendor_id string, ord bigint, display_name string")

    def run():
        stream = ingest.message_stream(spark, str(inbox), schema)
        handle = ingest.posting_sink(base, bills, vendors, post_in_order)
        ingest.start_batches(stream, handle, f"{base}/state").awaitTermination()

    drop(inbox, "1.json", [row(1, "Acme Supplies", "N1"), row(2, "Zed", "N1")])
    run()
    drop(inbox, "2.json", [row(1, "Acme Supplies Inc", "N2") | {"message_id": "m3"}, row(4, "Other", "N1")])
    run()
    got = {r.message_id: (r.status, r.duplicate_of, r.vendor_name, r.vendor_match) for r in ingest.read_checked(spark, base).collect()}
    assert got == {
        "m1": ("created", None, "Acme Supplies", "new"), "m2": ("duplicate", "m1", None, None),
        "m3": ("created", None, "Acme Supplies", "fuzzy"), "m4": ("duplicate", "m1", None, None),
    }


def test_fan_out_handles_every_message_once(spark, tmp_path):
    base = str(tmp_path)
    schema = "message_id string, label string, has_attachment boolean, arrival long, invoice_number string"

    def drafts(rows):
        nothing = {c: F.lit(None).cast("string") for c in ("subject", "memo", "invoice_date", "due_date", "file_url")}
        return rows.withColumns({"vendor_display_name": F.lit("V"), "total_amount": F.lit(1.0), **nothing})

    handle = ingest.fan_out_sink(base, {"invoice": drafts})
    one = spark.createDataFrame([("a", "invoice", True, 1, "N1"), ("a", "invoice", True, 2, "N1"), ("b", "none", False, 3, None), ("c", "invoice", True, 4, "N1")], schema)
    two = spark.createDataFrame([("a", "shipping", True, 5, "N1"), ("d", "invoice", True, 6, "N1"), ("e", "invoice", True, 7, "N2"), ("f", "invoice", False, 8, "N3")], schema)
    handle(one, 0)
    for _ in range(2):  # the second try replaces the first
        handle(two, 1)
    read = lambda name: sorted(tuple(r) for r in ingest.read_fanned(spark, base, name).select("batch", "message_id").collect())
    assert read("processed") == [(0, "a"), (0, "b"), (0, "c"), (1, "d"), (1, "e"), (1, "f")]
    assert read("tracker_invoice") == [(0, "a"), (1, "e")]
    labels = ingest.read_fanned(spark, base, "labels")
    update = spark.createDataFrame([("b", "insurance", 2, 1), ("d", "none", 0, 9)], "message_id string, label string, batch int, seq long")
    table = KeyedTable(spark, f"{base}/current", "message_id string, label string, batch int, seq long", ["message_id"], 8)
    table.upsert(labels, 0, ["batch", "seq"])
    table.upsert(update, 1, ["batch", "seq"])
    now = {r.message_id: r.label for r in table.read().collect()}
    assert now == {"a": "invoice", "b": "insurance", "c": "invoice", "d": "invoice", "e": "invoice", "f": "invoice"}
