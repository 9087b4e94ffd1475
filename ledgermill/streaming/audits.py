"""Duplicate audits kept up to date: a micro-batch costs its own rows and the buckets they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.duplicates import UNKNOWN
from ..operators.joins import keyed_join
from ..operators.keyed_table import KeyedTable
from ..session import cut_lineage, discard

_SOFT = ["txn_type", "total_amt", "txn_date"]
_HARD = [*_SOFT, "party"]


class Audit:
    """Group sizes by type, amount, date and party, and the number of duplicate groups per type, as two keyed tables.

    Both carry the number of the micro-batch as version. The change of the numbers of groups follows from the group sizes
    of the version before and of the new one, in the buckets that the batch touches.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.groups = KeyedTable(
            spark, f"{path}/groups", "txn_type string, total_amt double, txn_date string, party string, n long", _HARD, buckets, _SOFT
        )
        self.summary = KeyedTable(spark, f"{path}/summary", "txn_type string, hard long, soft long", ["txn_type"], 1)

    def _counted(self, touched: list[int], version: int | None) -> DataFrame:
        """(txn_type, hard, soft): numbers of groups of more than one row in the touched buckets."""
        rows = self.groups.in_buckets(touched, version) if version is not None else self.groups.read(-1)
        soft = rows.groupBy(*_SOFT).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("hard"))
        return soft.groupBy("txn_type").agg(F.sum("hard").alias("hard"), F.count_if(F.col("n") > 1).alias("soft"))

    def add(self, txns: DataFrame, batch_id: int) -> None:
        """Take in a batch of posted transactions; once more under the same number changes nothing."""
        counted = txns.withColumn("party", F.coalesce("party", F.lit(UNKNOWN))).groupBy(*_HARD).agg(F.count(F.lit(1)).alias("n"))
        counted = cut_lineage(counted.select(*[F.col(f.name).cast(f.dataType) for f in self.groups.schema]))
        self.groups.merge(counted, batch_id, lambda rows: rows.groupBy(*_HARD).agg(F.sum("n").alias("n")))
        earlier = [v for v in self.groups.versions() if v < batch_id]
        # Amounts and dates lie in one bucket each, and those the batch does not have count alike before and after.
        touched = self.groups.rewritten(batch_id)
        before = self._counted(touched, earlier[-1] if earlier else None)
        after = self._counted(touched, batch_id)
        change = keyed_join(after, before.withColumnsRenamed({"hard": "h", "soft": "s"}), ["txn_type"], "left", null_safe=True).select(
            "txn_type", (F.col("hard") - F.coalesce("h", F.lit(0))).alias("hard"), (F.col("soft") - F.coalesce("s", F.lit(0))).alias("soft")
        )
        self.summary.merge(change, batch_id, lambda rows: rows.groupBy("txn_type").agg(
            F.sum("hard").alias("hard"), F.sum("soft").alias("soft")
        ))
        discard(counted)

    def read(self, version: int | None = None) -> DataFrame:
        """txn_type, strictness, n_groups as ``duplicate_summary`` gives them, after the latest batch or after ``version``."""
        rows = self.summary.read(version)
        both = F.array(*[
            F.struct(F.lit(k).alias("strictness"), F.col(k).alias("n_groups")) for k in ("hard", "soft")
        ])
        found = rows.select("txn_type", F.inline(both))
        return found.filter((F.col("txn_type") != "Deposit") | (F.col("strictness") == "soft"))


def audit_sink(audit: Audit) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that keeps an audit up to date."""
    return lambda batch, batch_id: audit.add(batch, batch_id)
