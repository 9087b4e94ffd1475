"""Master tables and reports over them: customers, vendors, accounts, transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import address_line, present

NO_CUSTOMERS = "No customers with addresses found."


def read_master(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A master table from parquet, optionally with a fixed schema."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def expense_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter(F.col("account_type") == "Expense").select("account_id", "name")


def default_bank_account(accounts: DataFrame, types: tuple[str, ...] = ("Bank", "Credit Card")) -> DataFrame:
    """The first account, by scan position, that money can be paid from: one row or none."""
    return (
        accounts.filter(F.col("account_type").isin(*types))
        .orderBy("ord")
        .limit(1)
        .select(
            F.col("account_id").alias("bank_account_id"), F.col("name").alias("bank_account_name")
        )
    )


def recent_transactions(bills: DataFrame, purchases: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` bills and the first ``n`` purchases by scan position, for display."""

    def head(df: DataFrame, kind: str, party_default: str, with_doc: bool) -> DataFrame:
        doc = F.coalesce(present(F.col("doc_number")), F.lit("N/A"))
        return df.orderBy("ord").limit(n).select(
            F.lit(kind).alias("txn_type"),
            "txn_id",
            F.coalesce("party", F.lit(party_default)).alias("party"),
            "total_amt",
            "txn_date",
            (doc if with_doc else F.lit(None).cast("string")).alias("doc_number"),
            (F.lit(None).cast("string") if with_doc else F.col("payment_type")).alias("payment_type"),
        )

    return head(bills, "Bill", "Unknown", True).unionByName(head(purchases, "Purchase", "N/A", False))


def customers_context(customers: DataFrame) -> DataFrame:
    """``- name: billing | shipping`` per customer with an address, with its position.

    One row per line rather than one long string, so that it stays distributed;
    ``write_context`` writes the lines in order.
    """
    addresses = F.array_distinct(
        F.array_compact(
            F.array(
                address_line("bill_addr.line1", "bill_addr.line2", "bill_addr.city"),
                address_line("ship_addr.line1", "ship_addr.line2", "ship_addr.city"),
            )
        )
    )
    return (
        customers.select("ord", "display_name", addresses.alias("a"))
        .filter(F.size("a") > 0)
        .select(
            "ord",
            F.concat(
                F.lit("- "), F.col("display_name"), F.lit(": "), F.array_join("a", " | ")
            ).alias("line"),
        )
    )


def context_or_notice(context: DataFrame) -> DataFrame:
    """The context lines, or the one-line notice where there are none."""
    spark = context.sparkSession
    notice = spark.range(1).select(F.lit(0).cast("bigint").alias("ord"), F.lit(NO_CUSTOMERS).alias("line"))
    lines = context.limit(1).agg(F.count(F.lit(1))).scalar()
    return context.unionByName(notice.filter(lines == 0))


def write_context(context: DataFrame, path: str) -> None:
    """Write the lines as text files whose concatenation is the whole context in order."""
    context_or_notice(context).orderBy("ord").select("line").write.text(path)
