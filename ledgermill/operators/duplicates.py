"""Duplicate detection: audits over posted transactions and checks of incoming drafts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import blank, normalize_date, present
from ..session import cut_lineage
from .joins import first_per_key, keyed_join

TOLERANCE = 0.01
# Amount buckets are twice the tolerance wide, so two amounts within the tolerance lie
# in the same or in neighbouring buckets, rounding included.
_BUCKETS_PER_UNIT = 50
UNKNOWN = "Unknown"


# --- audits of posted transactions -------------------------------------------------


def _keys(strict: bool) -> list[str]:
    return (["party"] if strict else []) + ["total_amt", "txn_date"]


def _named(txns: DataFrame) -> DataFrame:
    return txns.withColumn("party", F.coalesce("party", F.lit(UNKNOWN)))


def duplicate_groups(txns: DataFrame, txn_type: str, strict: bool) -> DataFrame:
    """Groups of more than one transaction of a type with equal amount and date.

    ``strict`` groups also share the party. Nulls are ordinary key values. A group is
    one row with its size and its first and last id; ``duplicate_members`` lists the rows.
    """
    rows = _named(txns.filter(F.col("txn_type") == txn_type))
    groups = rows.groupBy(*_keys(strict)).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("txn_id").alias("first_id"),
        F.max("txn_id").alias("last_id"),
    )
    return groups.filter(F.col("n") > 1)


def duplicate_members(txns: DataFrame, strict: bool) -> DataFrame:
    """Every transaction that belongs to a duplicate group, with its party and the group's size.

    Deposits have no party of their own and are always grouped by amount and date only. Groups are
    counted with partial aggregates and joined back, so no task ever holds a whole group.
    """
    deposit = F.col("txn_type") == "Deposit"
    rows = _named(txns).withColumn("_who", F.when(~deposit, F.col("party")) if strict else F.lit(""))
    keys = ["txn_type", "_who", "total_amt", "txn_date"]
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return keyed_join(rows, groups, keys, "inner", null_safe=True).drop("_who")


def duplicate_summary(txns: DataFrame) -> DataFrame:
    """Number of duplicate groups per type and strictness (hard, soft).

    Soft groups are rolled up from the hard groups' counts, so the rows are read and
    shuffled once. Deposits have no party and therefore no hard groups.
    """
    hard = _named(txns).groupBy("txn_type", "party", "total_amt", "txn_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    soft = hard.groupBy("txn_type", "total_amt", "txn_date").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("hard")
    )
    counted = soft.groupBy("txn_type").agg(
        F.sum("hard").alias("hard"), F.count_if(F.col("n") > 1).alias("soft")
    )
    return counted.select(
        "txn_type",
        F.inline(
            F.array(
                F.struct(F.lit("hard").alias("strictness"), F.col("hard").alias("n_groups")),
                F.struct(F.lit("soft").alias("strictness"), F.col("soft").alias("n_groups")),
            )
        ),
    ).filter((F.col("txn_type") != "Deposit") | (F.col("strictness") == "soft"))


# --- checks of incoming drafts -------------------------------------------------------


def bill_totals(bill_lines: DataFrame) -> DataFrame:
    """Sum of the line amounts per bill."""
    return bill_lines.groupBy("bill_id").agg(F.sum("amount").alias("total"))


def with_totals(bills: DataFrame, bill_lines: DataFrame) -> DataFrame:
    """Bills with the sum of their lines; a bill without lines has total 0."""
    joined = keyed_join(bills, bill_totals(bill_lines), ["bill_id"], "left")
    return joined.withColumn("total", F.coalesce("total", F.lit(0.0)))


def first_bill_by_number(bills: DataFrame) -> DataFrame:
    """(invoice_number, num_ord, num_bill): first bill per document number."""
    numbered = bills.filter(~blank(F.col("doc_number"))).select(
        F.col("doc_number").alias("invoice_number"),
        F.col("ord").alias("num_ord"),
        F.col("bill_id").alias("num_bill"),
    )
    return first_per_key(numbered, ["invoice_number"], ["num_ord"])


def dup_by_number(drafts: DataFrame, bills: DataFrame) -> DataFrame:
    """Drafts with the first bill of the same number, whatever its vendor; else null.

    A blank number is turned to null and matches nothing.
    """
    numbered = drafts.withColumn("_number", F.col("invoice_number")).withColumn(
        "invoice_number", present(F.col("invoice_number"))
    )
    found = keyed_join(numbered, first_bill_by_number(bills), ["invoice_number"], "left")
    return found.drop("invoice_number").withColumnRenamed("_number", "invoice_number")


def _bucket(amount: Column) -> Column:
    # A double, since amounts may be larger than any integer type holds.
    return F.rint(amount * _BUCKETS_PER_UNIT)


def amount_matches(probes: DataFrame, bills: DataFrame) -> DataFrame:
    """First bill per distinct (vendor, date, total) probe with the amount in tolerance.

    Both sides are reduced to distinct vendor, date and amount first, so copies of one
    transaction meet once; only amounts in neighbouring buckets are compared.
    """
    keys = ["vendor", "date"]
    side = first_per_key(
        bills.select(
            F.col("vendor_name").alias("vendor"),
            F.col("txn_date").alias("date"),
            F.col("total").alias("bill_total"),
            F.col("ord").alias("amt_ord"),
            F.col("bill_id").alias("amt_bill"),
        ).filter(F.col("vendor").isNotNull()),
        [*keys, "bill_total"],
        ["amt_ord"],
    )
    side = side.withColumn("bucket", _bucket(F.col("bill_total")))
    # The probes are repeated for the neighbouring buckets, as a batch is smaller than what was posted before it.
    near = F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: _bucket(F.col("total")) + d)
    wanted = probes.select(*keys, "total").distinct().withColumn("bucket", F.explode(near))
    pairs = keyed_join(
        wanted, side, [*keys, "bucket"], "inner", null_safe=True,
        residual=F.abs(F.col("bill_total") - F.col("total")) < TOLERANCE,
    )
    return first_per_key(pairs.select(*keys, "total", "amt_ord", "amt_bill"), [*keys, "total"], ["amt_ord"])


_AMOUNT_KEYS = ["vendor", "date", "total"]


def _amount_keys(drafts: DataFrame) -> DataFrame:
    return drafts.withColumns(
        {
            "vendor": F.col("vendor_display_name"),
            "date": normalize_date(F.col("invoice_date")),
            "total": F.col("total_amount"),
        }
    )


def dup_by_vendor_date_amount(drafts: DataFrame, bills: DataFrame) -> DataFrame:
    """Drafts with the first bill of the same vendor, date and amount; else null.

    The vendor is the draft's own text, the date its normalised form (null equals
    null), the amount lies strictly within the tolerance of the bill's total.
    """
    keyed = _amount_keys(drafts)
    # Written out, so that its real size decides how it is joined.
    found = cut_lineage(amount_matches(keyed.filter(F.col("total").isNotNull()), bills))
    joined = keyed_join(keyed, found, _AMOUNT_KEYS, "left", null_safe=True)
    return joined.drop(*_AMOUNT_KEYS)


def duplicate_bills(drafts: DataFrame, bills: DataFrame, position: str | None = None) -> DataFrame:
    """Drafts with the first bill in scan order that matches by number or by amount.

    Adds duplicate_of and duplicate_rule (null where there is no duplicate). ``bills``
    needs bill_id, ord, vendor_name, txn_date, doc_number and total. ``position`` names a
    column for the found bill's ord.
    """
    amounts = _amount_keys(drafts)
    found = cut_lineage(amount_matches(amounts.filter(F.col("total").isNotNull()), bills))
    numbers = first_bill_by_number(bills)
    keyed = amounts.withColumn("_number", present(F.col("invoice_number")))
    both = keyed_join(
        keyed, numbers.withColumnRenamed("invoice_number", "_number"), ["_number"], "left"
    )
    both = keyed_join(
        both, found, _AMOUNT_KEYS, "left", null_safe=True, profile=keyed
    ).drop("_number", *_AMOUNT_KEYS)
    by_number = F.struct(
        F.col("num_ord").alias("ord"), F.lit("number").alias("rule"), F.col("num_bill").alias("bill")
    )
    by_amount = F.struct(
        F.col("amt_ord").alias("ord"), F.lit("vendor_date_amount").alias("rule"), F.col("amt_bill").alias("bill")
    )
    first = F.when(
        F.col("num_ord").isNotNull()
        & (F.col("amt_ord").isNull() | (F.col("num_ord") <= F.col("amt_ord"))),
        by_number,
    ).when(F.col("amt_ord").isNotNull(), by_amount)
    return (
        both.withColumn("_first", first)
        .withColumn("duplicate_of", F.col("_first.bill"))
        .withColumn("duplicate_rule", F.col("_first.rule"))
        .withColumns({position: F.col("_first.ord")} if position else {})
        .drop("_first", "num_ord", "num_bill", "amt_ord", "amt_bill")
    )


def new_to_tracker(drafts: DataFrame, tracker: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Drafts whose invoice number the tracker does not hold yet.

    Within the batch the first arrival per number passes; blank numbers all pass.
    """
    named = drafts.filter(~blank(F.col("invoice_number")))
    unnamed = drafts.filter(blank(F.col("invoice_number")))
    held = tracker.filter(~blank(F.col("po_number"))).select(F.col("po_number").alias("invoice_number"))
    fresh = first_per_key(named, ["invoice_number"], [arrival, "message_id"])
    fresh = keyed_join(fresh, held.distinct(), ["invoice_number"], "left_anti")
    return fresh.unionByName(unnamed)


def tracker_exists(drafts: DataFrame, tracker: DataFrame) -> DataFrame:
    """Drafts with ``exists``: whether the tracker holds their number; blank is false."""
    held = tracker.filter(~blank(F.col("po_number"))).select(
        F.col("po_number").alias("invoice_number"), F.lit(True).alias("exists")
    )
    joined = keyed_join(drafts, held.distinct(), ["invoice_number"], "left")
    return joined.withColumn("exists", F.coalesce("exists", F.lit(False)))


def bill_purchase_reconcile(purchases: DataFrame, bills: DataFrame) -> DataFrame:
    """Bank transactions with the first bill of the same party, date and amount, or null."""
    keyed = purchases.withColumns(
        {"vendor": F.col("party"), "date": F.col("txn_date"), "total": F.col("total_amt")}
    )
    found = cut_lineage(amount_matches(keyed.filter(F.col("total").isNotNull()), bills))
    joined = keyed_join(keyed, found, ["vendor", "date", "total"], "left", null_safe=True)
    return joined.drop("vendor", "date", "total", "amt_ord").withColumnRenamed("amt_bill", "matched_bill")
