"""Drafts to ledger transactions in one go: checks, masters, headers, detail lines, and what is left out."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_ACCOUNT
from ..session import cut_lineage
from . import ledger
from .duplicates import duplicate_bills
from .inorder import post_in_order
from .joins import keyed_join
from .resolve import resolve_customers, resolve_vendors


@dataclass(frozen=True)
class Posting:
    """``bills`` and ``purchases`` are headers, ``lines`` detail and tax lines with their customer; ``vendors``
    are names to register, ``rejected`` the drafts that were not posted, with a reason."""

    bills: DataFrame
    purchases: DataFrame
    lines: DataFrame
    vendors: DataFrame
    rejected: DataFrame

    def write(self, path: str) -> None:
        """Write every part below ``path``; the same batch written again replaces itself."""
        for part in fields(self):
            getattr(self, part.name).write.mode("overwrite").parquet(os.path.join(path, part.name))


def post_drafts(
    drafts: DataFrame, lines: DataFrame, bills: DataFrame, vendors: DataFrame, customers: DataFrame,
    accounts: DataFrame, run_date: str, in_order: bool = False, default_account: str = DEFAULT_ACCOUNT,
) -> Posting:
    """Post drafts (header columns, tax and message_id) with their flat ``lines`` (message_id, item, ...).

    Runs eagerly: what several parts share is written out once. A draft without a positive total is
    rejected, a bill that repeats a posted one too; receipts are not checked for that. ``in_order`` also checks
    each draft against earlier ones of the batch (needs arrival and lines_total), see ``post_in_order``.
    """
    receipt = F.coalesce("is_receipt", F.lit(False))
    if in_order:
        outcome = cut_lineage(post_in_order(drafts, bills, vendors))
        fresh = outcome.filter("status = 'created'")
        repeated = outcome.filter("status = 'duplicate'")
        invalid = outcome.filter("status = 'rejected'").withColumn("reason", F.lit(ledger.NO_TOTAL))
    else:
        valid, invalid = ledger.split_by_total(drafts)
        none = {c: F.lit(None).cast("string") for c in ("duplicate_of", "duplicate_rule")}
        checked = cut_lineage(
            duplicate_bills(valid.filter(~receipt), bills).unionByName(valid.filter(receipt).withColumns(none))
        )
        repeated = checked.filter("duplicate_of is not null")
        fresh = resolve_vendors(checked.filter("duplicate_of is null"), vendors)
    created = cut_lineage(resolve_customers(fresh, customers))
    kind = created.select(
        "message_id", "customer_id", "tax", ledger.txn_type(F.col("is_receipt")).alias("txn_type")
    )
    carry = ["message_id", "txn_type", "customer_id"]
    detail = keyed_join(lines, kind.drop("tax"), ["message_id"], "inner")
    posted = ledger.ledger_lines(detail, carry, default_account).unionByName(
        ledger.tax_lines(kind, carry, default_account)
    )
    receipts = created.filter(receipt)
    rejected = (
        invalid.select("message_id", "reason")
        .unionByName(repeated.select("message_id", F.concat(F.lit("duplicate of "), "duplicate_of").alias("reason")))
        .unionByName(ledger.unpayable(receipts, accounts).select("message_id", "reason"))
    )
    return Posting(
        ledger.build_bills(created.filter(~receipt)),
        ledger.build_purchases(receipts, accounts, run_date),
        posted, ledger.register_vendors(created), rejected,
    )
