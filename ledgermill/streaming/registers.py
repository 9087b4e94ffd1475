"""Duplicate check inside a stream: stateful registers of numbers and of amounts.

Two stateful operators follow each other. The first, by invoice number, knows who brought a number first. The
second, by vendor and date, holds the amounts of posted bills and of accepted drafts. Keys are dealt by hash to a fixed number of
buckets, and a bucket costs one read and at most one write of its state per micro-batch, however many of its keys the batch
brings: a call of a Python state is dear, an entry is not. Bills posted before the stream began are the initial state, one row
per bucket. State lives in RocksDB, is restored from the checkpoint and, with a lifetime, expires key by key.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import normalize_date, present
from ..operators.duplicates import TOLERANCE

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Buckets of each register. A bucket's entries are held in memory while its drafts are checked.
BUCKETS = 4096
# One list per column; the entries of a bucket are the lists' elements, ``at`` when an entry's key was last written.
_HELD = "number array<string>, ord array<long>, id array<string>, at array<long>"
_AMOUNTS = "vendor array<string>, day array<string>, total array<double>, ord array<long>, id array<string>, at array<long>"
_DRAFT = "message_id string, ord long, vendor string, day string, total double"


class _Register(StatefulProcessor):
    """The entries of a bucket, as tuples of ``columns`` and the time of writing. The bucket expires after its last key."""

    columns: tuple[str, ...] = ()
    schema = ""

    def __init__(self, lifetime_ms: int | None = None):
        self.lifetime_ms = lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.schema, self.lifetime_ms)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        lists = [initialState[c] for c in self.columns]
        self.held.update((*lists, [timerValues.getCurrentProcessingTimeInMs()] * len(lists[0])))

    def entries(self, now: int) -> Iterator[tuple]:
        state = self.held.get()
        for entry in zip(*state) if state is not None else ():
            if self.lifetime_ms is None or entry[-1] + self.lifetime_ms > now:
                yield entry

    def close(self) -> None:
        pass


class NumberRegister(_Register):
    """Per invoice number: who brought it first. Each draft gets that bill or earlier draft."""

    columns, schema = ("number", "ord", "id"), _HELD

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        first = {number: rest for number, *rest in self.entries(now)}
        known = len(first)
        for r in sorted(rows, key=lambda r: (r["ord"], r["message_id"])):
            held = first.get(r["number"])
            yield Row(
                message_id=r["message_id"], ord=r["ord"], vendor=r["vendor"], day=r["day"], total=r["total"],
                num_ord=held[0] if held else None, num_id=held[1] if held else None,
            )
            if held is None:
                first[r["number"]] = [r["ord"], r["message_id"], now]
        if len(first) > known:
            self.held.update((list(first), *map(list, zip(*first.values()))))


class AmountRegister(_Register):
    """Per vendor and date: amounts of bills and accepted drafts, ascending. A draft that nothing equals is accepted."""

    columns, schema = ("vendor", "day", "total", "ord", "id"), _AMOUNTS

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held: dict[tuple, list[tuple]] = {}
        written: dict[tuple, int] = {}
        for vendor, day, total, ord_, id_, at in self.entries(now):
            held.setdefault((vendor, day), []).append((total, ord_, id_))
            written[vendor, day] = at
        for amounts in held.values():
            amounts.sort()
        more = False
        for r in sorted(rows, key=lambda r: (r["ord"], r["message_id"])):
            total = r["total"]
            amounts = held.setdefault((r["vendor"], r["day"]), [])
            # Wider than the tolerance; what lies inside is compared exactly.
            at, near = bisect_left(amounts, (total - 2 * TOLERANCE,)), []
            while at < len(amounts) and amounts[at][0] <= total + 2 * TOLERANCE:
                if abs(amounts[at][0] - total) < TOLERANCE:
                    near.append(amounts[at][1:])
                at += 1
            first = min(near, default=None)
            by_number = None if r["num_ord"] is None else (r["num_ord"], r["num_id"])
            if first is None and by_number is None:
                insort(amounts, (total, r["ord"], r["message_id"]))
                written[r["vendor"], r["day"]], more = now, True
                found = rule = None
            elif first is None or by_number is not None and by_number[0] <= first[0]:
                found, rule = by_number[1], "number"
            else:
                found, rule = first[1], "vendor_date_amount"
            yield Row(message_id=r["message_id"], ord=r["ord"], duplicate_of=found, duplicate_rule=rule)
        if more:
            entries = ((*k, *amount, written[k]) for k, amounts in held.items() for amount in amounts)
            self.held.update(tuple(map(list, zip(*entries))))


def _dealt(*keys: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _by_bucket(rows: DataFrame, keys: list[str], columns: tuple[str, ...], buckets: int) -> DataFrame:
    """One row per bucket: a list per column."""
    held = rows.groupBy(_dealt(*keys, buckets=buckets)).agg(F.collect_list(F.struct(*columns)).alias("held"))
    return held.select("bucket", *[F.col(f"held.{c}").alias(c) for c in columns])


def check_stream(
    drafts: DataFrame, bills: DataFrame, lifetime_ms: int | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """A stream of drafts with the first bill or earlier accepted draft that each one repeats, or nulls.

    ``drafts`` (message_id, ord, invoice_number, vendor_display_name, invoice_date, total_amount) come in ascending ``ord``
    from batch to batch; within a batch they may lie in any order. ``bills`` (bill_id, ord, vendor_name, txn_date,
    doc_number, total) were posted before and have smaller positions. Result: message_id, ord, duplicate_of, duplicate_rule
    (number or vendor_date_amount; the one found earlier, the number on ties).

    A number counts as used from the first bill or draft that brought it, also if that draft was a duplicate by amount;
    amounts count only of bills and of drafts that are no duplicates. Empty numbers, and null vendors or totals, match nothing; a null
    date equals a null date. With ``lifetime_ms``, numbers and amounts not renewed for so long are forgotten; as that goes by
    the clock, such a stream runs with an interval until it is stopped, not until nothing new is there.
    Keys are dealt to ``buckets`` buckets, fixed for the life of the checkpoint. A bucket's drafts of one micro-batch and its entries,
    one in ``buckets`` of all, are held in memory and are one task's work, as a draft's outcome depends on all before it. Streams that
    are to hold far more than a hundred million entries take more buckets; it is also the most calls of state that a micro-batch makes.
    """
    wanted = drafts.select(
        "message_id", F.col("ord").cast("long").alias("ord"), present(F.col("invoice_number")).alias("number"),
        F.col("vendor_display_name").alias("vendor"), normalize_date(F.col("invoice_date")).alias("day"),
        F.col("total_amount").cast("double").alias("total"),
    )
    mode = "ProcessingTime" if lifetime_ms else "None"
    numbers = bills.select(
        present(F.col("doc_number")).alias("number"), F.col("ord").cast("long").alias("ord"), F.col("bill_id").cast("string").alias("id")
    ).filter("number is not null")
    # One entry per key value, however many bills share it.
    numbers = numbers.groupBy("number").agg(F.min_by("id", "ord").alias("id"), F.min("ord").alias("ord"))
    none = [F.lit(None).cast("long").alias("num_ord"), F.lit(None).cast("string").alias("num_id")]
    numbers = _by_bucket(numbers, ["number"], NumberRegister.columns, buckets)
    by_number = wanted.filter("number is not null").withColumn("bucket", _dealt("number", buckets=buckets))
    numbered = by_number.groupBy("bucket").transformWithState(
        NumberRegister(lifetime_ms), f"{_DRAFT}, num_ord long, num_id string", "Append", mode, numbers.groupBy("bucket")
    )
    known = numbered.unionByName(wanted.filter("number is null").drop("number").select("*", *none))

    def comparable(c: str = "vendor") -> Column:
        return F.col(c).isNotNull() & F.col("total").isNotNull() & ~F.isnan("total")

    amounts = bills.select(
        F.col("vendor_name").alias("vendor"), F.col("txn_date").cast("string").alias("day"), F.col("total").cast("double").alias("total"),
        F.col("ord").cast("long").alias("ord"), F.col("bill_id").cast("string").alias("id"),
    ).filter(comparable())
    amounts = amounts.groupBy("vendor", "day", "total").agg(F.min_by("id", "ord").alias("id"), F.min("ord").alias("ord"))
    amounts = _by_bucket(amounts, ["vendor", "day"], AmountRegister.columns, buckets)
    checked = known.filter(comparable()).withColumn("bucket", _dealt("vendor", "day", buckets=buckets)).groupBy("bucket").transformWithState(
        AmountRegister(lifetime_ms), "message_id string, ord long, duplicate_of string, duplicate_rule string",
        "Append", mode, amounts.groupBy("bucket"),
    )
    others = known.filter(~comparable()).select(
        "message_id", "ord", F.col("num_id").alias("duplicate_of"),
        F.when(F.col("num_id").isNotNull(), "number").alias("duplicate_rule"),
    )
    return checked.unionByName(others)


def with_rocksdb(spark, start):
    """Starts a query with the RocksDB state store, which stateful processors need, whatever the session's own setting."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
