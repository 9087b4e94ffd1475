"""One-to-one reconciliation of bank transactions with bills.

A transaction and a bill may belong together when the party is equal and date and amount lie close. Possible pairs have
one strict order: nearest date, nearest amount, then the values themselves, then the positions. A pair
that is first for both sides is settled; rounds of settling give the one stable matching under this order.

Rows that agree in party, date and amount are one class. Rounds work on classes and their counts, so a class of a million
copies is one row there; its members are numbered in a distributed way and dealt out by number at the end.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, discard
from .duplicates import TOLERANCE
from .joins import keyed_join

log = logging.getLogger(__name__)
_CLASS = ["party", "day", "amount"]


def number_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "number") -> DataFrame:
    """``df`` with each row's place, from 0, among the rows of equal ``keys`` (null equals null).

    Rows are range-partitioned by keys and order, so a group may span many tasks; places follow from the counts of
    the partitions before, of which there is one number per group and partition.
    """
    sorted_rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    local = F.monotonically_increasing_id()
    rows = cut_lineage(sorted_rows.select("*", F.shiftright(local, 33).alias("_p"), local.alias("_i")))
    parts = rows.groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = keyed_join(rows, parts.drop("_n"), [*keys, "_p"], "inner", null_safe=True)
    return joined.withColumn(name, F.col("_i") - F.col("_first") + F.col("_before")).drop("_p", "_i", "_first", "_before")


def _candidates(txns: DataFrame, bills: DataFrame, tolerance: float, days: int) -> DataFrame:
    """Pairs of classes that may belong together, with the key that orders them.

    Bands of date and amount are twice as wide as the limits, so partners lie in equal or neighbouring bands.
    """
    width, span = 2 * tolerance, max(1, 2 * days)

    def banded(df: DataFrame, reach: int) -> DataFrame:
        rows = df.withColumns({
            "_a": F.rint(F.col("amount") / width), "_d": F.floor(F.unix_date("day") / span),
        })
        steps = F.array(*[F.lit(k) for k in range(-reach, reach + 1)])
        if not reach:
            return rows
        rows = rows.withColumn("_da", F.explode(steps)).withColumn("_dd", F.explode(steps if days else F.array(F.lit(0))))
        return rows.withColumns({"_a": F.col("_a") + F.col("_da"), "_d": F.col("_d") + F.col("_dd")}).drop("_da", "_dd")

    left = banded(txns.select(*_CLASS, F.col("n").alias("t_left")), 0)
    right = banded(bills.select(*_CLASS, F.col("n").alias("b_left")), 1).withColumnsRenamed(
        {"day": "b_day", "amount": "b_amount"}
    )
    gap, apart = F.abs(F.col("amount") - F.col("b_amount")), F.abs(F.date_diff("day", "b_day"))
    pairs = keyed_join(left, right, ["party", "_a", "_d"], "inner", residual=(gap < tolerance) & (apart <= days))
    return pairs.select(
        *_CLASS, "b_day", "b_amount", "t_left", "b_left",
        F.struct(apart.alias("apart"), gap.alias("gap"), "day", "amount", "b_day", "b_amount").alias("rank"),
    )


def _classes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_CLASS).agg(F.count(F.lit(1)).alias("n"))


def reconcile(txns: DataFrame, bills: DataFrame, tolerance: float = TOLERANCE, days: int = 0) -> DataFrame:
    """Every transaction with the one bill that it settles, or null: ``txns`` columns and bill_id.

    ``txns`` has txn_id, ord, party, day (a date) and amount; ``bills`` has bill_id, ord and the same. Amounts differ by less than
    ``tolerance``, dates by ``days`` at most. No bill and no transaction is used twice. Rows with a null party, date or
    amount are never matched. Among copies the smaller ``ord`` comes first, then the id. Rounds: the longest chain of
    classes of which each prefers the next, at most the number of classes of one such chain; they are logged.
    """
    usable = F.col("party").isNotNull() & F.col("day").isNotNull() & F.col("amount").isNotNull() & ~F.isnan("amount")
    columns = txns.columns
    t_rows = number_in_groups(txns.filter(usable), _CLASS, ["ord", "txn_id"])
    b_rows = number_in_groups(bills.filter(usable).select("bill_id", "ord", *_CLASS), _CLASS, ["ord", "bill_id"])
    edges = cut_lineage(
        _candidates(_classes(t_rows), _classes(b_rows), tolerance, days)
        .withColumns({"t_used": F.lit(0).cast("long"), "b_used": F.lit(0).cast("long")})
    )
    b_class = ["party", "b_day", "b_amount"]
    settled: DataFrame | None = None
    rounds = 0
    while not edges.isEmpty():
        rounds += 1
        t_best = edges.groupBy(*_CLASS).agg(F.min("rank").alias("rank"))
        b_best = edges.groupBy(*b_class).agg(F.min("rank").alias("rank"))
        # The classes' values are part of the rank, so equal ranks of one party are the same pair.
        mutual = keyed_join(keyed_join(edges, t_best, [*_CLASS, "rank"], "left_semi"), b_best, [*b_class, "rank"], "left_semi")
        now = cut_lineage(mutual.withColumn("q", F.least("t_left", "b_left")).drop("rank"))
        settled = now if settled is None else settled.unionByName(now)
        t_taken = now.select(*_CLASS, F.col("q").alias("t_q"))
        b_taken = now.select(*b_class, F.col("q").alias("b_q"))
        rest = keyed_join(keyed_join(edges, t_taken, _CLASS, "left"), b_taken, b_class, "left")
        t_q, b_q = F.coalesce("t_q", F.lit(0)), F.coalesce("b_q", F.lit(0))
        rest = rest.withColumns({
            "t_left": F.col("t_left") - t_q, "t_used": F.col("t_used") + t_q,
            "b_left": F.col("b_left") - b_q, "b_used": F.col("b_used") + b_q,
        }).drop("t_q", "b_q").filter((F.col("t_left") > 0) & (F.col("b_left") > 0))
        last, edges = edges, cut_lineage(rest)
        discard(last)
        log.info("reconciliation round %d settled some classes", rounds)
    log.info("reconciliation took %d rounds", rounds)
    if settled is None:
        return txns.withColumn("bill_id", F.lit(None).cast("string"))
    settled = settled.select(*_CLASS, "b_day", "b_amount", "t_used", "b_used", "q")
    t_given = keyed_join(
        t_rows, settled, _CLASS, "inner", force_salt=True,
        residual=(F.col("number") >= F.col("t_used")) & (F.col("number") < F.col("t_used") + F.col("q")),
    ).select("txn_id", F.col("ord").alias("t_ord"), "party", "b_day", "b_amount", (F.col("number") - F.col("t_used") + F.col("b_used")).alias("place"))
    named = b_rows.select("party", F.col("day").alias("b_day"), F.col("amount").alias("b_amount"), F.col("number").alias("place"), "bill_id")
    pairs = keyed_join(t_given, named, [*b_class, "place"], "inner").select("txn_id", "t_ord", "bill_id")
    out = txns.join(
        pairs.withColumnsRenamed({"txn_id": "_t", "t_ord": "_o"}),
        F.col("txn_id").eqNullSafe(F.col("_t")) & F.col("ord").eqNullSafe(F.col("_o")), "left",
    )
    return out.select(*columns, "bill_id")
