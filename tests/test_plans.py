"""What the physical plans must look like, and that the catalogue is complete."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from ledgermill.operators import duplicates as D
from ledgermill.operators import resolve as R
from ledgermill.plans import views as V
from ledgermill.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables are absent")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_and_catalogue(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_no_pairing_of_whole_sides(spark):
    for name in ("dup_by_number", "dup_by_vendor_date_amount", "duplicate_bills", "ledger_lines", "vendor_exact",
                 "customer_exact", "dup_members", "unprocessed_messages", "new_to_tracker"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["latest_messages"](spark, SF))


def test_summary_reads_and_shuffles_rows_once(spark):
    text = plan(QUERIES["dup_summary"](spark, SF))
    assert text.count("lineitem.parquet") == 1 and "Expand" not in text


def test_scans_are_pruned_and_filtered(spark):
    text = plan(QUERIES["bill_totals"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    text = plan(QUERIES["export_processed"](spark, SF))
    assert "EqualTo(event_type,error)" in text


def test_checks_hold_without_broadcast(spark):
    """The same results when no side may be broadcast, so every join shuffles."""
    names = ("duplicate_bills", "vendor_exact", "customer_by_address", "dup_members", "new_to_tracker", "ledger")
    rows = lambda name: sorted(map(str, QUERIES[name](spark, SF).collect()))
    normal = {name: rows(name) for name in names}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            assert rows(name) == normal[name], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_vendor_and_number(spark):
    """A third of the drafts share one vendor, date and number."""
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("message_id"),
        F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("V"), (F.col("id") % 97).cast("string"))).alias("vendor_display_name"),
        F.when(F.col("id") % 3 == 0, "N0").otherwise(F.concat(F.lit("N"), F.col("id").cast("string"))).alias("invoice_number"),
        F.lit("2026-03-05").alias("invoice_date"), (F.col("id") % 5).cast("double").alias("total_amount"),
    )
    bills = spark.createDataFrame(
        [("b1", 1, "Hot", "2026-03-05", None, 2.0), ("b2", 2, "V1", "2026-03-05", "N0", 9.0)],
        "bill_id string, ord bigint, vendor_name string, txn_date string, doc_number string, total double",
    )
    got = D.duplicate_bills(rows, bills).groupBy("duplicate_of").count().collect()
    hot_two = len([i for i in range(0, 3000, 3) if i % 5 == 2])
    assert {r.duplicate_of: r["count"] for r in got} == {"b1": hot_two, "b2": 1000 - hot_two, None: 2000}


def test_no_job_runs_while_a_query_is_built(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in ("category_to_account", "nested_ledger_lines", "extract_invoice", "quarantine_invoices", "ledger_lines"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, SF)
        stages = [s for j in tracker.getJobIdsForGroup(f"build-{name}") for s in tracker.getJobInfo(j).stageIds]
        # Reading a table's schema is a job of one stage.
        assert len(stages) <= 8 and all(tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks <= 1 for s in stages), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_views_use_whole_tables(spark):
    assert V.drafts(spark, SF).count() == V.table(spark, SF, "orders").count()
    assert V.transactions(spark, SF).count() == V.table(spark, SF, "lineitem").count()
    assert R.address_strings(V.customers(spark, SF)).count() > 0
