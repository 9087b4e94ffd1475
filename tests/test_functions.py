from pyspark.sql import functions as F

from ledgermill.functions import scalars as S
from ledgermill.functions import text as T
from ledgermill.functions.rules import category_to_account


def column(spark, values, expression, ddl="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r.x for r in rows.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_category(spark):
    cases = {
        "materials": "63", "labor": "59", "equipment": "29", "fuel": "56", "supplies": "20", "MATERIALS": "63",
        "  materials  ": "63", "plants and soil": "66", "unknown": "31", "": "31", None: "31", "a": "69", "Rental": "62",
        "Equipment Repair": "29", "Parental leave": "17", "garden": "65", "Tools": "31", "PROMO": "16", "   ": "31",
    }
    assert column(spark, list(cases), category_to_account) == list(cases.values())
    parity = column(spark, ["   "], lambda c: category_to_account(c, blank_matches_first=True))
    assert parity == ["69"]


def test_dates(spark):
    cases = {
        "03/15/2026": "2026-03-15", None: None, "": None, "2026-03-15": "2026-03-15", "3/5/2026": "2026-03-05",
        "02/30/2026": "02/30/2026", "13/01/2026": "13/01/2026", "03/15/26": "03/15/26", "soon": "soon",
    }
    assert column(spark, list(cases), S.normalize_date) == list(cases.values())
    run = lambda c: S.receipt_date(c, F.lit("2026-01-01"))
    assert column(spark, ["03/15/2026", "2026-03-15", "", None], run) == ["2026-03-15", "2026-01-01", None, None]


def test_number_text_equals_python(spark):
    values = [8.0, 0.5, 1e7, 12345678.9, 1e16, 1.5e17, 0.0001, 0.00012345, 1e-5, 2.5e-7, 0.001, 123456789012345.6, -1e8, 0.0]
    assert column(spark, values, S.number_text, "double") == [repr(v) for v in values]


def test_text_fields(spark):
    assert column(spark, ["x" * 3000, "", None], S.truncate_text) == ["x" * 2000, None, None]
    assert column(spark, ["", None, "Re"], lambda c: S.title(c, F.lit(""), default="Invoice")) == ["Invoice", "Invoice", "Re"]
    assert column(spark, ["id", "", None], S.email_link) == [S.MAIL_LINK_PREFIX + "id", None, None]
    bullets = column(spark, [["a", "b"], [], None], S.bullets, "array<string>")
    assert bullets == ["* a\n* b", None, None]


def test_shipping_fields(spark):
    rows = spark.createDataFrame(
        [("FedEx", "1"), ("UPS", "2"), ("USPS", "3"), ("DHL", "4"), (None, "5"), ("UPS", None), ("", "")],
        "carrier string, number string",
    )
    c, n = F.col("carrier"), F.col("number")
    got = rows.select(
        S.tracking_link(c, n).alias("link"), S.carrier_option(c).alias("option"),
        S.shipment_title(c, n, F.lit("PO")).alias("title"),
    ).collect()
    assert [bool(r.link) for r in got] == [True, True, True, False, False, False, False]
    assert [r.option for r in got] == ["FedEx", "UPS", "USPS", "Other", None, "UPS", None]
    assert [r.title for r in got] == ["FedEx - 1", "UPS - 2", "USPS - 3", "DHL - 4", "5", "UPS - PO", "PO"]
    assert column(spark, ["in transit", "DELIVERED", "x", None], S.delivery_status) == ["In Transit", "Delivered", "Unknown", "Unknown"]
    assert column(spark, ["DHL Express", "freight"], S.carrier_option) == ["Other", "Freight"]
    assert column(spark, ["high", "LOW", "critical", None], S.urgency_option) == ["High", "Low", None, None]


def test_items_text(spark):
    items = [[("lumber", 2.0, "12 lb"), ("nails", 0.0, ""), ("saw", None, None)], []]
    got = column(spark, items, S.shipment_items_text, "array<struct<description:string,quantity:double,weight:string>>")
    assert got == ["lumber (qty: 2.0) [12 lb]\nnails\nsaw", None]


def test_files(spark):
    names = ["a.pdf", "b.JPG", "c.jpeg", "d.png", "e.heic", ".pdf", "x/y.tar.pdf"]
    pdf, jpg, png, other = "application/pdf", "image/jpeg", "image/png", "application/octet-stream"
    assert column(spark, names, S.mime_type) == [pdf, jpg, jpg, png, other, other, pdf]
    got = column(spark, ["https://h/a/b.pdf", "", None], S.file_property)
    assert [r and (r.name, r.url) for r in got] == [("b.pdf", "https://h/a/b.pdf"), None, None]


def test_html(spark):
    cases = {
        "<p> Hello <b>big</b> world </p><p>x</p>": "Hellobigworldx",
        '<script>var t="</p>";</script><!-- <b>no</b> -->a &amp;lt; &#39;b&#x2019; &copy;<i> </i>&nbsp;': "a &lt; 'b’ ©",
        "plain & simple &zzz;": "plain & simple &zzz;",
        "": "", None: None,
    }
    assert column(spark, list(cases), T.html_to_text) == list(cases.values())
    assert column(spark, ["<p>a</p> <p>b</p>"], lambda c: T.html_to_text(c, " ")) == ["a b"]


def test_base64url(spark):
    assert column(spark, ["aGk", "aGk=", "", None], T.decode_base64url_text) == ["hi", "hi", None, None]
    assert [bytes(x) for x in column(spark, ["_-8", "", None], T.decode_base64url)] == [b"\xff\xef", b"", b""]


def test_context(spark):
    ddl = "array<struct<filename:string,text:string>>"
    files = [[("a.pdf", "body"), ("b.jpg", None)], [], None]
    classify = column(spark, files, lambda a: T.classifier_context(F.lit("m"), a), ddl)
    assert classify == ["m\n\nAttachments found:\n- a.pdf\n- b.jpg\n", "m", "m"]
    extract = column(spark, files, lambda a: T.extractor_context(F.lit("m"), a), ddl)
    assert extract[0] == "m\n\nAttachment contents:\n\n--- a.pdf ---\nbody\n\n--- b.jpg (binary file) ---\n"
    assert column(spark, [["p1", None, "p3"]], T.join_pages, "array<string>") == ["p1\n\np3"]


def test_references_tags_and_exponents(spark):
    cases = {
        "&check;": "\u2713", "&NewLine;x": "\nx", "&#00000065;": "A", "&#9999999;": "\ufffd", "&#0;": "\ufffd",
        "&#xD800;": "\ufffd", "&#x1F600;": "\U0001f600", "&#150;": "\u2013", "&#65 b": "A b", "&fjlig;": "fj",
        "a &amp b &copy;": "a & b \u00a9", "&nosuch; &": "&nosuch; &",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.html_to_text(F.col("t")).alias("out"))
    assert {r.t: r.out for r in df.collect()} == cases
    pages = spark.createDataFrame([("<b>x < y</b>",), ("<p>1<2</p><!-- c --><i>z</i>",)], "t string")
    assert [r[0] for r in pages.select(T.html_to_text(F.col("t"), " ")).collect()] == ["x < y", "1<2 z"]
    numbers = spark.createDataFrame([(1e300,), (1e16,), (1.5e-7,), (2.5e-300,)], "x double")
    assert [r[0] for r in numbers.select(S.number_text(F.col("x"))).collect()] == ["1e+300", "1e+16", "1.5e-07", "2.5e-300"]
