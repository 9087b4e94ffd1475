"""SQL functions against their column forms, invoice lines as a table function, the trained classifier."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgermill.functions import rules, scalars, sql
from ledgermill.operators import mail_model
from ledgermill.operators.models import classify
from ledgermill.plans.live import desk_mail
from ledgermill.session import fresh_path

TEXTS = [
    None, "", " ", "01/02/2026", "1/ 2/2026", "13/40/2026", "2/30/2025", "2026-01-02", "soon", "FedEx", "usps", "DHL", "Delivered", "in transit",
    "HIGH", "invoice", "none", "spam", "a.pdf", "b/c.JPG", ".pdf", "x.y.Png", " Fuel \t", "  labor", "gardens", "gas bill", "Parental leave", "x" * 3000, "it's \\ 'quoted'",
]
NUMBERS = [None, 0.0, 1.0, 2.5, 1e-5, 1.5e-7, 1e15, 1e16, 1.25e20, -3.0, 123456789.125, 1e7, 12345678.9, 0.001, float("nan")]


def test_sql_functions_equal_the_column_functions(spark):
    sql.register(spark)
    t, x, c = F.col("t"), F.col("x"), F.col("c")
    frame = spark.createDataFrame([(a, NUMBERS[k % len(NUMBERS)], TEXTS[(k * 7 + 3) % len(TEXTS)]) for k, a in enumerate(TEXTS)], "t string, x double, c string")
    pairs = {
        "iso_date(t)": scalars.normalize_date(t), "receipt_day(t, '2026-01-01')": scalars.receipt_date(t, F.lit("2026-01-01")),
        "field_text(t)": scalars.truncate_text(t), "number_text(x)": scalars.number_text(x), "line_amount(x, x)": scalars.line_amount(x, x),
        "line_description(t, x, x)": scalars.line_description(t, x, x), "expense_account(t)": rules.category_to_account(t),
        "mime_type_of(t)": scalars.mime_type(t), "label_category(t)": scalars.label_category(t), "carrier_option(t)": scalars.carrier_option(t),
        "delivery_status(t)": scalars.delivery_status(t), "urgency_option(t)": scalars.urgency_option(t), "email_link(t)": scalars.email_link(t),
        "tracking_link(c, t)": scalars.tracking_link(c, t), "shipment_title(c, t, c)": scalars.shipment_title(c, t, c), "money_text(x)": scalars.round2(x),
    }
    assert len(pairs) == len(sql.FUNCTIONS)
    rows = frame.select("t", "x", *[F.expr(k).alias(f"s{i}") for i, k in enumerate(pairs)], *[v.alias(f"c{i}") for i, v in enumerate(pairs.values())])
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    for r in rows.collect():
        for i, name in enumerate(pairs):
            assert repr(r[f"s{i}"]) == repr(r[f"c{i}"]), (name, r.t, r.x)


def test_invoice_lines_as_a_table_function(spark):
    sql.register(spark)
    line = "struct<item:string,rate:double,quantity:double,description:string,category:string>"
    drafts = spark.createDataFrame(
        [("a", [("x", 2.0, None, None, "Fuel"), ("y", 1.0, 3.0, None, None)], 1.5), ("b", [], 0.0), ("c", None, 2.0), ("d", [], 4.0), ("a", [], None)],
        f"message_id string, line_items array<{line}>, tax double",
    )
    drafts.createOrReplaceTempView("some_drafts")
    got = spark.sql("SELECT * FROM invoice_lines(TABLE(some_drafts) PARTITION BY message_id) ORDER BY message_id, pos").collect()
    assert [tuple(r) for r in got] == [
        ("a", 0, False, "x", 2.0, 1.0, "Fuel"), ("a", 1, False, "y", 1.0, 3.0, None), ("a", 2, True, "Tax", 1.5, 1.0, None), ("d", 0, True, "Tax", 4.0, 1.0, None),
    ]


def test_trained_classifier_on_held_out_mail(spark):
    mail = desk_mail(spark, "/root/testdata/sf0.01")
    held = mail_model.held_out(F.col("message_id"))
    model = mail_model.train_classifier(mail.filter(~held))
    path = fresh_path(spark, "mail-model")
    model.write().save(path)
    answers = mail_model.classify_trained(mail.filter(held), PipelineModel.load(path))
    assert "Python" not in answers._jdf.queryExecution().executedPlan().toString()
    joined = answers.withColumnRenamed("label", "answer").join(mail, "message_id").filter("label is not null")
    score = mail_model.macro_f1(joined)
    print(f"held-out macro F1 {score:.3f}")
    assert score >= 0.95
    odd = spark.createDataFrame([("1", None), ("2", ""), ("3", "?!"), ("4", "unseen wordsalad")], "message_id string, text string")
    by_rule = {r.message_id: r.label for r in odd.select("message_id", classify(F.col("text")).alias("label")).collect()}
    got = {r.message_id: r.label for r in mail_model.classify_trained(odd, model).collect()}
    assert {k: got[k] for k in "123"} == {k: by_rule[k] for k in "123"} and got["4"] is not None
    assert {r.message_id: r.label for r in mail_model.classify_trained(odd, None).collect()} == by_rule
