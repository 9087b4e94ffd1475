import base64
import json

from pyspark.sql import functions as F

from ledgermill.schemas import CUSTOMERS
from ledgermill.session import fresh_path
from ledgermill.sources import masters, messages, processed


def b64(text):
    return base64.b64encode(text.encode()).decode()


def b64url(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def test_messages(spark, tmp_path):
    rows = [
        dict(message_id="1", subject="a", body_type="html", body="<p>Hi <b>you</b></p>", received_at="2026-01-01T00:00:00", has_attachments=True,
             attachments=[dict(name="logo.png", content_b64=b64("x"), is_inline=True), dict(name="inv.pdf", content_b64=b64("pdf")),
                          dict(name="", content_b64=b64("x")), dict(name="e.txt", content_b64=""), dict(name="p.jpg", content_b64=b64("jpg"), is_inline=False)]),
        dict(message_id="2", body_type="text", body="<plain>", received_at="2026-01-02T00:00:00"),
        dict(message_id="3", body_type="text", received_at="2026-01-02T00:00:00", has_attachments=False, attachments=[dict(name="a", content_b64=b64("x"))]),
    ]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, rows)))
    mail = messages.read_messages(spark, str(tmp_path))
    got = {r.message_id: r for r in messages.scan_messages(mail).collect()}
    assert got["1"].text == "Hiyou" and [a.name for a in got["1"].attachments] == ["inv.pdf", "p.jpg"]
    assert got["2"].text == "<plain>" and got["2"].subject == "" and got["2"].attachments is None
    assert got["3"].text == "" and got["3"].attachments is None
    files = messages.scan_attachments(mail).orderBy("pos").collect()
    assert [(r.message_id, r.pos, r.filename, bytes(r.content)) for r in files] == [("1", 0, "inv.pdf", b"pdf"), ("1", 1, "p.jpg", b"jpg")]
    assert [r.message_id for r in messages.latest_messages(mail, 2).collect()] == ["2", "3"]


def tree():
    return {
        "headers": [{"name": "SUBJECT", "value": "first"}, {"name": "Subject", "value": "last"}],
        "body": {"data": ""},
        "parts": [
            {"body": {"data": ""}},
            {"mimeType": "text/html", "body": {"data": b64url("<p>Hello</p>")}},
            {"filename": "a.txt", "body": {"data": b64url("A")}, "parts": [{"filename": "hidden", "body": {"data": b64url("H")}}]},
            {"parts": [{"filename": "b.pdf", "body": {"attachmentId": "att1"}, "parts": [{"filename": "c.txt", "body": {"data": b64url("C")}}]}]},
        ],
    }


def test_mime(spark):
    mail = spark.createDataFrame([("m", json.dumps(tree())), ("n", json.dumps({"body": {"data": b64url("x")}}))], "message_id string, payload string")
    parsed = {r.message_id: (r.subject, r.text) for r in messages.parse_mime(mail).collect()}
    assert parsed == {"m": ("last", "Hello"), "n": ("", "x")}
    got = {(tuple(r.part_path), r.filename, r.content and bytes(r.content), r.attachment_id) for r in messages.flatten_mime_parts(mail).collect()}
    assert got == {((2,), "a.txt", b"A", None), ((3, 0), "b.pdf", None, "att1"), ((3, 0, 0), "c.txt", b"C", None)}


def test_mime_of_any_depth(spark):
    node = {"filename": "deep.txt", "body": {"data": b64url("D")}}
    for k in range(19):
        node = {"parts": [{"body": {"data": ""}}, node]} if k % 2 else {"parts": [node]}
    rows = [("m", json.dumps(node)), ("n", json.dumps(tree())), ("o", "not json"), ("p", None)]
    mail = spark.createDataFrame(rows, "message_id string, payload string")
    got = {(r.message_id, tuple(r.part_path), r.filename) for r in messages.flatten_mime_parts(mail).collect()}
    path = tuple(0 if k % 2 == 0 else 1 for k in range(18, -1, -1))
    assert got == {("m", path, "deep.txt"), ("n", (2,), "a.txt"), ("n", (3, 0), "b.pdf"), ("n", (3, 0, 0), "c.txt")}


def test_mime_is_lazy_at_depth_300_and_with_odd_values(spark):
    node = {"filename": "deep.txt", "body": {"attachmentId": "a1"}}
    for _ in range(300):
        node = {"parts": [node]}
    odd = {"parts": [1, None, "x", {"filename": 5, "body": {"data": b64url("N")}}, {"filename": "f", "body": []}, {"filename": "g", "body": None, "parts": {}}]}
    rows = [("m", json.dumps(node)), ("n", json.dumps(odd)), ("o", "[" * 100_000), ("p", "{"), ("q", None), ("r", "3"), ("m", json.dumps(odd))]
    mail = spark.createDataFrame(rows, "message_id string, payload string")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    parts = messages.flatten_mime_parts(mail)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    got = sorted((r.message_id, tuple(r.part_path), r.filename, r.content and bytes(r.content), r.attachment_id) for r in parts.collect())
    assert got == [("m", (0,) * 300, "deep.txt", None, "a1"), ("m", (3,), "5", b"N", None), ("n", (3,), "5", b"N", None)]


def test_malformed_base64_is_set_aside(spark):
    rows = [("1", [("a.pdf", b64("pdf")), ("b.pdf", "a"), ("c.pdf", "!!!!"), ("d.pdf", "cGRm\ncGRm")])]
    mail = spark.createDataFrame(rows, "message_id string, a array<struct<name:string,content_b64:string>>").selectExpr(
        "message_id", "true as has_attachments",
        "transform(a, x -> named_struct('name', x.name, 'content_b64', x.content_b64, 'is_inline', false)) as attachments",
    )
    good, bad = messages.readable_attachments(messages.scan_attachments(mail))
    assert sorted((r.filename, bytes(r.content)) for r in good.collect()) == [("a.pdf", b"pdf"), ("d.pdf", b"pdfpdf")]
    assert sorted(r.filename for r in bad.collect()) == ["b.pdf", "c.pdf"]
    tree_of = lambda data: json.dumps({"parts": [{"filename": "f", "body": {"data": data}}]})
    parts = spark.createDataFrame([("m", tree_of("a")), ("n", tree_of("QQ"))], "message_id string, payload string")
    assert {r.message_id: r.content and bytes(r.content) for r in messages.flatten_mime_parts(parts).collect()} == {"m": None, "n": b"A"}


def test_processed_arrays_over_lines(spark, tmp_path):
    cases = {
        '["a", "b"\n, "c"]': "abc", '["a", "b",\n "c", "d"]': "abcd", '["a",\n"b",\n"c"': "", '["a"]\n["b"]\n': "ab",
        "[]": "", '[\n"x y"\n]\n': None, '"a"\n"b",\n': "ab", '{"message_id": "a"}\n{"message_id": "b"}': "ab", "": "",
    }
    for k, (text, ids) in enumerate(cases.items()):
        path = tmp_path / f"{k}.json"
        path.write_text(text)
        got = sorted(r.message_id for r in processed.load_processed(spark, str(path)).collect())
        assert got == (["x y"] if ids is None else list(ids)), text


def test_extraction_route(spark):
    rows = spark.createDataFrame(
        [("a.PDF", "long enough text"), ("a.pdf", "  short \n"), ("a.pdf", None), ("b.JPG", None), ("c.png", None), ("d.txt", "x"), (None, None)],
        "f string, t string",
    )
    got = [r[0] for r in rows.select(messages.extraction_route(F.col("f"), F.col("t"))).collect()]
    assert got == ["pdf_text", "pdf_image", "pdf_image", "image", "image", None, None]


def test_processed(spark, tmp_path):
    missing = processed.load_processed(spark, str(tmp_path / "none.json"))
    assert missing.count() == 0
    (tmp_path / "bad.json").write_text("{not json")
    assert processed.load_processed(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "list.json").write_text(json.dumps(["b", "a"], indent=2))
    pretty = processed.load_processed(spark, str(tmp_path / "list.json"))
    assert [r.message_id for r in processed.export_processed(pretty).collect()] == ["a", "b"]
    (tmp_path / "flat.json").write_text(json.dumps(["b", "a"]))
    assert processed.load_processed(spark, str(tmp_path / "flat.json")).count() == 2
    new = spark.createDataFrame([("b",), ("c",), ("c",)], "message_id string")
    assert processed.mark_processed(pretty, new).count() == 3
    path = fresh_path(spark, "processed")
    processed.save_processed(processed.load_processed(spark, path), new, path)
    processed.save_processed(processed.load_processed(spark, path), new, path)
    assert sorted(r.message_id for r in processed.load_processed(spark, path).collect()) == ["b", "c"]


def test_next_messages(spark):
    mail = spark.createDataFrame([(str(i), i) for i in range(6)], "message_id string, received_at int")
    seen = spark.createDataFrame([("5",), ("4",)], "message_id string")
    assert [r.message_id for r in processed.next_messages(mail, seen, 2).collect()] == ["3", "2"]
    assert [r.message_id for r in processed.next_messages(mail, seen, 3, limit_first=True).collect()] == ["3"]


def test_customers_context(spark, tmp_path):
    customers = spark.createDataFrame(
        [
            ("1", 2, "Oak", ("1 Oak", "", "Town"), ("1 Oak", None, "Town")),
            ("2", 1, "Elm", ("2 Elm", None, None), ("Dock", None, None)),
            ("3", 3, "None", None, ("", None, None)),
        ],
        CUSTOMERS,
    )
    path = str(tmp_path / "context")
    masters.write_context(masters.customers_context(customers), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["- Elm: 2 Elm | Dock", "- Oak: 1 Oak, Town"]
    empty = masters.context_or_notice(masters.customers_context(customers.filter("ord = 3")))
    assert [r.line for r in empty.collect()] == [masters.NO_CUSTOMERS]


def test_accounts(spark):
    accounts = spark.createDataFrame(
        [("1", 3, "Checking", "Bank"), ("2", 1, "Tools", "Expense"), ("3", 2, "Card", "Credit Card")],
        "account_id string, ord bigint, name string, account_type string",
    )
    assert masters.default_bank_account(accounts).first().bank_account_id == "3"
    assert masters.default_bank_account(accounts, ("Bank",)).first().bank_account_id == "1"
    assert [r.account_id for r in masters.expense_accounts(accounts).collect()] == ["2"]
