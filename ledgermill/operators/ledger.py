"""Drafts to ledger transactions: validation, headers, detail lines, attachment links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_ACCOUNT, category_to_account
from ..functions.scalars import (
    items_total,
    line_amount,
    line_description,
    mime_type,
    normalize_date,
    present,
    receipt_date,
)

PAYMENT_TYPE = "CreditCard"
TAX_TEXT = "Tax"
NO_TOTAL = "total_amount missing or not positive"


def txn_type(is_receipt: Column) -> Column:
    """Receipts become purchases; false and unknown become bills."""
    return F.when(F.coalesce(is_receipt, F.lit(False)), "Purchase").otherwise("Bill")


def valid_total(total: Column) -> Column:
    return F.coalesce(total > 0, F.lit(False))


def split_by_total(drafts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drafts with a positive total, and the rest with a reason."""
    ok = valid_total(F.col("total_amount"))
    rejected = drafts.filter(~ok).withColumn("reason", F.lit(NO_TOTAL))
    return drafts.filter(ok), rejected


def check_totals(drafts: DataFrame, computed: Column | None = None, tolerance: float = 0.01) -> DataFrame:
    """Compare the stated total with lines plus tax and fill it in where it is missing."""
    expected = items_total(F.col("line_items"), F.col("tax")) if computed is None else computed
    checked = drafts.withColumn("computed_total", expected)
    return checked.withColumn(
        "mismatch",
        F.coalesce(F.abs(F.col("total_amount") - F.col("computed_total")) > tolerance, F.lit(False)),
    ).withColumn("total_amount", F.coalesce("total_amount", "computed_total"))


def explode_lines(drafts: DataFrame, carry: list[str], with_tax: bool = True) -> DataFrame:
    """Nested drafts to one row per line, the tax as one more line, in a single pass.

    Gives ``carry`` columns, pos, is_tax and the line's own columns.
    """
    lines = F.transform(
        "line_items",
        lambda x: F.struct(
            F.lit(False).alias("is_tax"),
            x["item"].alias("item"),
            x["rate"].alias("rate"),
            F.coalesce(x["quantity"], F.lit(1.0)).alias("quantity"),
            x["category"].alias("category"),
        ),
    )
    if with_tax:
        tax = F.struct(
            F.lit(True).alias("is_tax"),
            F.lit(TAX_TEXT).alias("item"),
            F.col("tax").alias("rate"),
            F.lit(1.0).alias("quantity"),
            F.lit(None).cast("string").alias("category"),
        )
        lines = F.when(F.col("tax") > 0, F.concat(lines, F.array(tax))).otherwise(lines)
    return drafts.select(*carry, F.posexplode(lines).alias("pos", "x")).select(*carry, "pos", "x.*")


def ledger_lines(lines: DataFrame, carry: list[str], default_account: str = DEFAULT_ACCOUNT) -> DataFrame:
    """Detail lines: amount, account and description of flat draft lines.

    ``lines`` has item, rate, quantity and category, and optionally is_tax. Where it has
    an account_id already (found once per category or product, say), that is taken.
    Everything is computed in the row; no join is needed.
    """
    is_tax = F.col("is_tax") if "is_tax" in lines.columns else F.lit(False)
    if "account_id" in lines.columns:
        account = F.col("account_id")
    else:
        account = category_to_account(F.col("category"), default_account)
    return lines.select(
        *carry,
        line_amount(F.col("rate"), F.col("quantity")).alias("amount"),
        F.when(is_tax, F.lit(default_account)).otherwise(account).alias("account_id"),
        F.when(is_tax, F.lit(TAX_TEXT))
        .otherwise(line_description(F.col("item"), F.col("quantity"), F.col("rate")))
        .alias("description"),
    )


def tax_lines(drafts: DataFrame, carry: list[str], default_account: str = DEFAULT_ACCOUNT) -> DataFrame:
    """One detail line on the default account per draft with a positive tax."""
    return drafts.filter(F.col("tax") > 0).select(
        *carry,
        F.col("tax").alias("amount"),
        F.lit(default_account).alias("account_id"),
        F.lit(TAX_TEXT).alias("description"),
    )


def _optional(columns: list[str], available: list[str]) -> list[Column]:
    return [F.col(c) if c in available else F.lit(None).cast("string").alias(c) for c in columns]


def build_bills(drafts: DataFrame) -> DataFrame:
    """Bill headers; blank fields become null, dates are normalised."""
    return drafts.select(
        "message_id",
        F.lit("Bill").alias("txn_type"),
        *_optional(["vendor_id", "vendor_name", "customer_id"], drafts.columns),
        normalize_date(F.col("invoice_date")).alias("txn_date"),
        normalize_date(F.col("due_date")).alias("due_date"),
        present(F.col("invoice_number")).alias("doc_number"),
    )


def build_purchases(drafts: DataFrame, accounts: DataFrame, run_date: str) -> DataFrame:
    """Purchase headers, paid from the first bank or card account.

    A stated date that cannot be read becomes ``run_date``. Without any such
    account nothing can be posted and the result is empty; see ``unpayable``.
    """
    from ..sources.masters import default_bank_account

    rows = drafts.select(
        "message_id",
        F.lit("Purchase").alias("txn_type"),
        F.lit(PAYMENT_TYPE).alias("payment_type"),
        *_optional(["vendor_id", "vendor_name", "customer_id"], drafts.columns),
        receipt_date(F.col("invoice_date"), F.lit(run_date)).alias("txn_date"),
    )
    # At most one account row, read as a scalar.
    account = default_bank_account(accounts).select("bank_account_id").scalar()
    return rows.withColumn("bank_account_id", account).filter(F.col("bank_account_id").isNotNull())


def unpayable(drafts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Receipts that cannot be posted because there is no bank or card account."""
    from ..sources.masters import default_bank_account

    account = default_bank_account(accounts).select("bank_account_id").scalar()
    reason = F.lit("no bank or credit card account")
    return drafts.filter(account.isNull()).withColumn("reason", reason)


def attachment_links(drafts: DataFrame, transactions: DataFrame) -> DataFrame:
    """Link a draft's file to the transaction made from its message."""
    from .joins import keyed_join

    files = drafts.filter(present(F.col("filename")).isNotNull()).select("message_id", "filename")
    txns = transactions.select("message_id", "txn_type", "txn_id")
    linked = keyed_join(files, txns, ["message_id"], "inner")
    return linked.select(
        F.substring_index("filename", "/", -1).alias("file_name"),
        mime_type(F.col("filename")).alias("content_type"),
        "txn_type",
        "txn_id",
    )


def register_vendors(resolved: DataFrame) -> DataFrame:
    """New vendor names of a resolved batch, one row per distinct name, spaces kept."""
    return (
        resolved.filter(F.col("vendor_match") == "new")
        .select(F.col("vendor_display_name").alias("display_name"))
        .distinct()
    )
