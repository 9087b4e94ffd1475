"""Post a batch as if its drafts came one after the other.

A draft becomes a bill unless an existing bill or one made by an *earlier draft of the
batch* matches it, and a vendor is registered unless an existing vendor or one registered
by an earlier draft matches. Neither dropping duplicates nor connected components
gives that, because tolerance and similarity are not transitive.

Every draft's outcome is a function of the outcomes of earlier drafts only. So the
whole batch is evaluated at once against an assumed set of created bills and registered
vendors, and again against the outcome, until nothing changes. A state that
reproduces itself is the sequential result (by induction over the arrival), and after k
rounds every draft with a chain of fewer than k predecessors is settled. Each round is made
of lookups into sets reduced by key; drafts are never paired with one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalize_date, strip
from ..session import cut_lineage, discard
from .duplicates import duplicate_bills
from .fuzzy import similar_pairs
from .joins import best_per_key, first_per_key, keyed_join
from .ledger import valid_total
from .resolve import VENDOR_THRESHOLD, vendor_exact, vendor_fuzzy


def _bills(created: DataFrame) -> DataFrame:
    """Created drafts in the shape of posted bills; the arrival is the scan position."""
    return created.select(
        F.col("message_id").alias("bill_id"),
        F.col("arrival").alias("ord"),
        "vendor_name",
        normalize_date(F.col("invoice_date")).alias("txn_date"),
        F.col("invoice_number").alias("doc_number"),
        F.col("lines_total").alias("total"),
    )


def _earlier_duplicate(drafts: DataFrame, created: DataFrame) -> DataFrame:
    """Drafts with the first created bill that precedes and matches them, or null."""
    bills = _bills(created)
    checked = duplicate_bills(drafts, bills, position="duplicate_ord")
    earlier = F.col("duplicate_ord") < F.col("arrival")
    return checked.withColumns(
        {c: F.when(earlier, F.col(c)) for c in ("duplicate_of", "duplicate_rule")}
    ).drop("duplicate_ord")


def _known_vendors(names: DataFrame, vendors: DataFrame, threshold: float) -> DataFrame:
    """(name, known_id, known_name, known_ratio): best existing vendor; ratio 2 when exact."""
    exact = vendor_exact(names, vendors)
    rest = exact.filter(F.col("master_id").isNull()).select("name")
    similar = vendor_fuzzy(rest, vendors, threshold)
    found = exact.filter(F.col("master_id").isNotNull()).withColumn("ratio", F.lit(2.0))
    return found.unionByName(similar).select(
        "name",
        F.col("master_id").alias("known_id"),
        F.col("master_name").alias("known_name"),
        F.col("ratio").alias("known_ratio"),
    )


def _resolve(active: DataFrame, registered: DataFrame, threshold: float) -> DataFrame:
    """Active drafts with vendor_name, vendor_match under an assumed set of registrations.

    ``registered`` has reg_name and reg_arrival. An exact match beats a fuzzy one; existing
    vendors come before registered ones.
    """
    by_text = first_per_key(
        registered.select(strip(F.col("reg_name")).alias("_text"), "reg_name", "reg_arrival"),
        ["_text"], ["reg_arrival"],
    ).withColumnsRenamed({"reg_name": "exact_name", "reg_arrival": "exact_arrival"})
    rows = keyed_join(
        active.withColumn("_text", strip(F.col("vendor_display_name"))), by_text, ["_text"], "left"
    ).drop("_text")
    rows = rows.withColumn(
        "exact_name", F.when(F.col("exact_arrival") < F.col("arrival"), F.col("exact_name"))
    ).drop("exact_arrival")
    # Registered vendors are unlike one another, so a name has few of them.
    names = active.filter(F.coalesce(F.col("known_ratio") < 2, F.lit(True))).select(
        F.col("vendor_display_name").alias("a")
    ).distinct()
    pairs = similar_pairs(
        names, registered.select(F.col("reg_name").alias("b"), F.col("reg_arrival").alias("ord")), threshold
    )
    near = keyed_join(
        active.select("message_id", "arrival", F.col("vendor_display_name").alias("a")), pairs, ["a"],
        "inner", residual=F.col("ord") < F.col("arrival"),
    ).select("message_id", "b", "ord", "ratio")
    near = best_per_key(near, ["message_id"], "ratio", ["ord"]).select(
        "message_id", F.col("b").alias("near_name"), F.col("ratio").alias("near_ratio")
    )
    rows = keyed_join(rows, near, ["message_id"], "left", profile=active)
    known, near_ratio = F.coalesce("known_ratio", F.lit(0.0)), F.coalesce("near_ratio", F.lit(0.0))

    def pick(exact_known: Column, exact: Column, fuzzy_known: Column, fuzzy: Column, new: Column) -> Column:
        return (
            F.when(known == 2, exact_known)
            .when(F.col("exact_name").isNotNull(), exact)
            .when((known > 0) & (known >= near_ratio), fuzzy_known)
            .when(near_ratio > 0, fuzzy)
            .otherwise(new)
        )

    name = pick(*[F.col(c) for c in ("known_name", "exact_name", "known_name", "near_name", "vendor_display_name")])
    match = pick(*[F.lit(t) for t in ("exact", "exact", "fuzzy", "fuzzy", "new")])
    nothing = F.lit(None).cast("string")
    vendor_id = pick(F.col("known_id"), nothing, F.col("known_id"), nothing, nothing)
    return rows.withColumns({"vendor_name": name, "vendor_match": match, "vendor_id": vendor_id}).drop(
        "exact_name", "near_name", "near_ratio"
    )


def _registrations(state: DataFrame) -> DataFrame:
    """First created draft per name that found no vendor."""
    return (
        state.filter((F.col("status") == "created") & (F.col("vendor_match") == "new"))
        .groupBy(F.col("vendor_display_name").alias("reg_name"))
        .agg(F.min("arrival").alias("reg_arrival"))
    )


def _first_guess(active: DataFrame) -> DataFrame:
    """Assumed registrations to start from: one unknown name per rough spelling.

    Any guess leads to the same result; a good one saves rounds.
    """
    rough = F.regexp_replace(F.lower("vendor_display_name"), "[^a-z]", "")
    names = active.filter(F.col("known_ratio").isNull()).select(
        rough.alias("rough"), F.col("vendor_display_name").alias("reg_name"), F.col("arrival").alias("reg_arrival")
    )
    return first_per_key(names, ["rough"], ["reg_arrival"]).select("reg_name", "reg_arrival")


def post_in_order(
    drafts: DataFrame, bills: DataFrame, vendors: DataFrame, threshold: float = VENDOR_THRESHOLD
) -> DataFrame:
    """Outcome of every draft of a batch, taken in order of ``arrival``.

    ``drafts`` needs message_id, arrival (unique), vendor_display_name, invoice_number,
    invoice_date, total_amount, lines_total (lines plus tax) and is_receipt. Adds status
    (created, duplicate, rejected), duplicate_of, duplicate_rule, vendor_name, vendor_id and
    vendor_match (exact, fuzzy, new; null unless created).
    """
    receipt = F.coalesce("is_receipt", F.lit(False))
    ok = valid_total(F.col("total_amount"))
    drafts = cut_lineage(drafts)
    checked = cut_lineage(
        duplicate_bills(drafts.filter(~receipt), bills)
        .unionByName(
            drafts.filter(receipt).withColumns(
                {c: F.lit(None).cast("string") for c in ("duplicate_of", "duplicate_rule")}
            )
        )
    )
    old = checked.filter(F.col("duplicate_of").isNotNull())
    fresh = checked.filter(F.col("duplicate_of").isNull()).drop("duplicate_of", "duplicate_rule")
    # Without a valid total a draft creates nothing, but may still repeat a created bill.
    passive = fresh.filter(~ok)
    names = fresh.filter(ok).select(F.col("vendor_display_name").alias("name")).distinct()
    known = _known_vendors(names, vendors, threshold).withColumnRenamed("name", "vendor_display_name")
    active = cut_lineage(keyed_join(fresh.filter(ok), known, ["vendor_display_name"], "left"))

    registered = cut_lineage(_first_guess(active))
    state = active.withColumns(
        {
            "status": F.lit("created"),
            "vendor_name": F.coalesce("known_name", "vendor_display_name"),
            "vendor_match": F.lit("new"),
        }
    )
    facts = ["status", "vendor_name", "vendor_match"]
    resolved = None
    while True:
        created = state.filter((F.col("status") == "created") & ~receipt)
        if resolved is None:
            resolved = cut_lineage(_resolve(active, registered, threshold))
        checked_bills = _earlier_duplicate(resolved.filter(~receipt), created)
        receipts = resolved.filter(receipt).withColumns(
            {c: F.lit(None).cast("string") for c in ("duplicate_of", "duplicate_rule")}
        )
        after = cut_lineage(
            checked_bills.unionByName(receipts).withColumn(
                "status", F.when(F.col("duplicate_of").isNull(), "created").otherwise("duplicate")
            )
        )
        now = _registrations(after)
        before = state.select("message_id", *[F.col(c).alias(f"old_{c}") for c in facts])
        same = F.lit(True)
        for c in facts:
            same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
        moved = keyed_join(after, before, ["message_id"], "left").filter(~same)
        unchanged = _same_rows(now, registered)
        if unchanged and moved.isEmpty():
            break
        done = [state] if state is not active and hasattr(state, "cut_path") else []
        state = after
        if not unchanged:
            done += [registered, resolved]
            registered, resolved = cut_lineage(now), None
        discard(*done)  # tables of earlier rounds

    final_bills = state.filter((F.col("status") == "created") & ~receipt)
    repeats = _earlier_duplicate(passive.filter(~receipt), final_bills).unionByName(
        passive.filter(receipt).withColumns(
            {c: F.lit(None).cast("string") for c in ("duplicate_of", "duplicate_rule")}
        )
    )
    columns = [*drafts.columns, "status", "duplicate_of", "duplicate_rule", "vendor_name", "vendor_id", "vendor_match"]
    nothing = {c: F.lit(None).cast("string") for c in ("vendor_name", "vendor_id", "vendor_match")}
    unsettled = old.unionByName(repeats).withColumns(nothing).withColumn(
        "status", F.when(F.col("duplicate_of").isNull(), "rejected").otherwise("duplicate")
    )
    settled = state.withColumns(
        {c: F.when(F.col("status") == "created", F.col(c)) for c in ("vendor_name", "vendor_id", "vendor_match")}
    )
    return settled.select(columns).unionByName(unsettled.select(columns))


def _same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether two sets of (reg_name, reg_arrival) are equal; reg_name is unique in each."""
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    return both.groupBy("reg_name", "reg_arrival").agg(F.sum("side").alias("s")).filter("s <> 0").isEmpty()
