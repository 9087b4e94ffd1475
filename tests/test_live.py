"""State: duplicate registers, paged feeds, sinks of several tables, keyed tables, audits, links, reconciliation."""

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import containment
from ledgermill.operators.duplicates import duplicate_summary
from ledgermill.operators.keyed_table import KeyedTable
from ledgermill.operators.reconcile import number_in_groups, reconcile
from ledgermill.session import fresh_path
from ledgermill.sources import feed
from ledgermill.streaming import ingest, registers, table_set
from ledgermill.streaming.audits import Audit, audit_sink
from ledgermill.streaming.links import link_stream

DRAFTS = "message_id string, ord long, invoice_number string, vendor_display_name string, invoice_date string, total_amount double"
BILLS = "bill_id string, ord long, vendor_name string, txn_date string, doc_number string, total double"


def put(spark, rows, schema, path, part):
    """One more file group of a stream's inbox."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{part}")
    time.sleep(0.02)


def inbox(spark, path, schema):
    return ingest.message_stream(
        spark, path, schema, fmt="parquet", max_files=1, recursiveFileLookup="true", pathGlobFilter="*.parquet"
    )


# --- duplicate registers ------------------------------------------------------------------


def checked_plainly(drafts, bills):
    """The sequential result, one draft after another."""
    numbers, amounts = {}, []
    for i, ord_, vendor, day, number, total in bills:
        if number:
            numbers[number] = min(numbers.get(number, (ord_, i)), (ord_, i))
        amounts.append((vendor, day, total, ord_, i))
    out = {}
    for i, ord_, number, vendor, day, total in sorted(drafts, key=lambda d: d[1]):
        if day and "/" in day:
            day = dt.datetime.strptime(day, "%m/%d/%Y").strftime("%Y-%m-%d")
        by_number = numbers.get(number) if number else None
        near = [(o, k) for v, d, t, o, k in amounts if vendor and total is not None and (v, d) == (vendor, day) and abs(t - total) < 0.01]
        by_amount = min(near, default=None)
        if number:
            numbers.setdefault(number, (ord_, i))
        if by_number is None and by_amount is None:
            if vendor and total is not None:
                amounts.append((vendor, day, total, ord_, i))
            out[i] = (None, None)
        elif by_amount is None or by_number and by_number[0] <= by_amount[0]:
            out[i] = (by_number[1], "number")
        else:
            out[i] = (by_amount[1], "vendor_date_amount")
    return out


def some_drafts(rng, n, batches=3):
    per, rows = n // batches, []
    for k in range(n):
        rows.append((
            f"m{k}", 1000 + k, rng.choice([None, "", "  ", f"N{rng.randrange(25)}", f"N{rng.randrange(25)}"]), rng.choice(["V", "W", None]),
            rng.choice(["01/02/2026", "2026-01-02", "2026-01-03", None]), rng.choice([None] + [10 + 0.004 * j for j in range(12)]),
        ))
    parts = [rows[b * per : (b + 1) * per if b < batches - 1 else n] for b in range(batches)]
    for part in parts:
        rng.shuffle(part)  # any order within a micro-batch
    return parts


def test_registers_equal_one_after_another_also_after_a_restart(spark):
    rng, base = random.Random(1), fresh_path(spark, "registers")
    bills = [("b1", 1, "V", "2026-01-02", "N1", 10.0), ("b2", 2, "V", "2026-01-02", None, 10.012), ("b3", 3, "W", None, "", 10.02), ("b4", 4, None, "2026-01-02", "N2", 10.0)]
    table = spark.createDataFrame(bills, BILLS)
    parts = some_drafts(rng, 120)
    for k, part in enumerate(parts):
        put(spark, part, DRAFTS, f"{base}/in", k)
        # Every batch is a run of its own, from the checkpoint of the one before.
        stream = registers.check_stream(inbox(spark, f"{base}/in", DRAFTS), table)
        registers.with_rocksdb(spark, lambda: ingest.start(stream, f"{base}/out", f"{base}/state")).awaitTermination()
    got = {r.message_id: (r.duplicate_of, r.duplicate_rule) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == checked_plainly([d for p in parts for d in p], bills)
    assert {rule for _, rule in got.values()} == {None, "number", "vendor_date_amount"}


def test_registers_keep_one_state_per_bucket_however_many_keys(spark):
    """Calls of state per micro-batch follow the buckets, not the numbers, vendors and days."""
    base = fresh_path(spark, "buckets")
    bills = [(f"b{k}", k, f"V{k}", "2026-01-02", f"N{k}", 10.0) for k in range(60)]
    drafts = [(f"m{k}", 1000 + k, f"N{k}" if k % 2 else None, f"V{k}", "2026-01-02", 10.0) for k in range(200)]
    put(spark, drafts, DRAFTS, f"{base}/in", 0)
    stream = registers.check_stream(inbox(spark, f"{base}/in", DRAFTS), spark.createDataFrame(bills, BILLS), buckets=8)
    query = registers.with_rocksdb(spark, lambda: ingest.start(stream, f"{base}/out", f"{base}/state"))
    query.awaitTermination()
    assert all(o["numRowsTotal"] <= 8 for o in query.lastProgress["stateOperators"])
    got = {r.message_id: (r.duplicate_of, r.duplicate_rule) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == checked_plainly(drafts, bills)


@pytest.mark.parametrize("lifetime_ms,found", [(1500, None), (600_000, "s0")])
def test_registers_forget_after_their_lifetime(spark, lifetime_ms, found):
    base, none = fresh_path(spark, "lifetime"), spark.createDataFrame([], BILLS)
    put(spark, [("s0", 0, "N1", "V", None, 5.0)], DRAFTS, f"{base}/in", 0)
    stream = registers.check_stream(inbox(spark, f"{base}/in", DRAFTS), none, lifetime_ms=lifetime_ms)
    query = registers.with_rocksdb(spark, lambda: ingest.start(stream, f"{base}/out", f"{base}/state", interval="1 second"))
    try:
        rows = {}
        for k in range(2):
            end = time.time() + 60
            while f"s{k}" not in rows and time.time() < end:
                time.sleep(1)
                # The log names what is committed; a bare listing would also show what is being written.
                done = os.path.isdir(f"{base}/out/_spark_metadata")
                rows = {r.message_id: r.duplicate_of for r in spark.read.schema("message_id string, duplicate_of string").parquet(f"{base}/out").collect()} if done else {}
            if k == 0:
                time.sleep(4)
                put(spark, [("s1", 1, "N1", "V", None, 5.0)], DRAFTS, f"{base}/in", 1)
    finally:
        query.stop()
    assert rows == {"s0": None, "s1": found}


# --- paged feed -----------------------------------------------------------------------------


@pytest.fixture
def mail_feed(spark):
    path = fresh_path(spark, "feed")
    start = dt.datetime(2026, 1, 1)
    rows = [(f"m{k}", f"subject {k}", start + dt.timedelta(hours=k), k // 10) for k in range(100)]
    frame = spark.createDataFrame(rows, "message_id string, subject string, received_at timestamp, page long")
    feed.write_pages(frame.filter("page < 6"), path)
    return path, frame


def test_feed_reads_pages_and_columns_that_are_asked_for(spark, mail_feed):
    path, frame = mail_feed
    spark.conf.set(feed.PUSHDOWN, "true")
    try:
        columns = "message_id string, received_at timestamp, page long"
        rows = feed.read_feed(spark, path, columns).filter("page >= 2 and page < 4 and received_at >= timestamp'2026-01-02 01:00:00' and message_id <> 'm27'")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        above = plan.split("BatchScan")[0]
        assert " >= " not in above and " < " not in above and "m27" in above  # pushed, pushed, left
        assert {r.message_id for r in rows.collect()} == {f"m{k}" for k in range(25, 40)} - {"m27"}
        reader = feed.MailFeed({"path": path, "pushdown": "true", "pagesPerTask": "1"}).reader(frame.schema)
        from pyspark.sql.datasource import EqualNullSafe, EqualTo, GreaterThan

        left = list(reader.pushFilters([EqualTo(("page",), 3), GreaterThan(("received_at",), dt.datetime(2026, 1, 2)), EqualNullSafe(("message_id",), "x")]))
        assert [type(f) for f in left] == [GreaterThan, EqualNullSafe]
        assert [p.pages for p in reader.partitions()] == [[3]]
    finally:
        spark.conf.unset(feed.PUSHDOWN)
    assert feed.read_feed(spark, path, "message_id string").count() == 60


def test_feed_leaves_out_broken_lines(spark, mail_feed):
    path, _ = mail_feed
    os.makedirs(f"{path}/page=6")
    with open(f"{path}/page=6/part.json", "w") as f:
        f.write('{"message_id": "x", "received_at": "no time"}\n{broken\n[1]\n\n"text"\n{"message_id": "y"}')
    rows = feed.read_feed(spark, path, "message_id string, received_at timestamp, page long").filter("page = 6").collect()
    assert [(r.message_id, r.received_at) for r in rows] == [("x", None), ("y", None)]
    assert feed.read_feed(spark, fresh_path(spark, "no-feed")).collect() == []


def test_feed_stream_goes_on_where_it_stopped(spark, mail_feed):
    path, frame = mail_feed
    base = fresh_path(spark, "feed-stream")

    def run(**options):
        stream = feed.stream_feed(spark, path, "message_id string, page long", pagesPerTask="2", **options)
        query = ingest.start(stream, f"{base}/out", f"{base}/state")
        query.awaitTermination()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]

    bounded = {"pagesPerBatch": "4", "cursor": f"{base}/cursor.json"}
    assert run(**bounded) == [40]  # stops in the middle of the feed
    feed.write_pages(frame.filter("page in (6, 7, 9)"), path)
    assert run(**bounded) == [40]  # page 8 is missing, so 9 waits
    assert run(**bounded) == []
    feed.write_pages(frame.filter("page = 8"), path)
    assert run(**bounded) == [20]
    assert sorted(r.message_id for r in spark.read.parquet(f"{base}/out").collect()) == sorted(f"m{k}" for k in range(100))
    with pytest.raises(Exception, match="cursor"):
        run(pagesPerBatch="1")


# --- several tables in one commit ------------------------------------------------------------


def test_a_failed_task_leaves_nothing_and_a_restart_writes_all_once(spark):
    base = fresh_path(spark, "tables")
    rows = [(k, f"m{k}") for k in range(200)]
    spark.createDataFrame(rows, "k long, message_id string").repartition(2).write.parquet(f"{base}/in")
    flag = f"{base}/works"

    @F.udf("string")
    def fragile(k, message_id):
        if k == 150 and not os.path.exists(flag):
            raise RuntimeError("planted failure")
        return message_id

    def run():
        mail = ingest.message_stream(spark, f"{base}/in", "k long, message_id string", fmt="parquet")
        named = mail.select("k", fragile("k", "message_id").alias("message_id"))
        tables = named.select(
            F.struct("message_id").alias("labels"), F.when(F.col("k") % 2 == 0, F.struct("message_id", "k")).alias("bills"),
            F.when(F.col("k") < 0, F.struct("k")).alias("never"),
        )
        table_set.start(tables, f"{base}/out", f"{base}/state").awaitTermination()

    with pytest.raises(Exception, match="planted failure"):
        run()
    assert table_set.read_table(spark, f"{base}/out", "labels") is None
    open(flag, "w").close()
    run()
    assert sorted(r.message_id for r in table_set.read_table(spark, f"{base}/out", "labels").collect()) == sorted(m for _, m in rows)
    assert sorted(r.k for r in table_set.read_table(spark, f"{base}/out", "bills").collect()) == list(range(0, 200, 2))
    assert table_set.read_table(spark, f"{base}/out", "never").columns == ["k"]
    table_set.clean(f"{base}/out")
    assert table_set.read_table(spark, f"{base}/out", "labels").count() == 200


def test_a_batch_that_is_committed_twice_counts_once(spark):
    from pyspark.sql.types import StructType

    base = fresh_path(spark, "twice")
    schema = spark.createDataFrame([], "t struct<a:int>").schema
    writer = table_set.TableSetWriter({"path": base}, schema)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"t": {"a": 1}}, {"t": None}, {"t": {"a": 2}}], pa.schema([("t", pa.struct([("a", pa.int32())]))]))
    first, again, dropped = (writer.write(iter([batch])) for _ in range(3))
    writer.commit([first, None], 0)
    writer.commit([again], 0)
    writer.abort([dropped], 1)
    assert [r.a for r in table_set.read_table(spark, base, "t").orderBy("a").collect()] == [1, 2]
    assert len(os.listdir(f"{base}/data/t")) == 1
    assert table_set.clean(base) == 0 and isinstance(schema, StructType)


# --- keyed table ------------------------------------------------------------------------------


def test_an_update_rewrites_the_buckets_it_touches(spark):
    table = KeyedTable(spark, fresh_path(spark, "keyed"), "k string, v long, at long", ["k"], 32)
    assert table.read().collect() == []
    rows = [(f"k{i}", i, 0) for i in range(500)] + [(None, -1, 0)]
    table.upsert(spark.createDataFrame(rows, "k string, v long, at long"), 0, ["at"])
    assert len(table.rewritten(0)) == 32
    table.upsert(spark.createDataFrame([("k7", 70, 1), ("k7", 71, 1), ("k7", 99, -1), ("new", 1, 1), (None, -2, 1)], "k string, v long, at long"), 3, ["at"])
    assert 1 <= len(table.rewritten(3)) <= 3
    want = {k: v for k, v, _ in rows} | {"k7": 71, "new": 1, None: -2}
    assert {r.k: r.v for r in table.read().collect()} == want and table.read().count() == len(want)
    assert {r.k: r.v for r in table.read(0).collect()} == {k: v for k, v, _ in rows}
    table.upsert(spark.createDataFrame([("k1", 5, 9)], "k string, v long, at long"), 3, ["at"])  # a retried batch
    assert {r.k: r.v for r in table.read().collect()} == want
    table.upsert(spark.createDataFrame([], "k string, v long, at long"), 4, ["at"])
    assert table.rewritten(4) == [] and table.versions() == [0, 3, 4]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([], "k string, v long, at long"), 2, ["at"])
    table.forget(keep=1)
    assert {r.k: r.v for r in table.read().collect()} == want and table.versions() == [4]


def test_a_failed_update_leaves_the_table_as_it_was(spark):
    table = KeyedTable(spark, fresh_path(spark, "keyed"), "k string, v long", ["k"], 4)
    table.upsert(spark.createDataFrame([("a", 1)], "k string, v long"), 0, ["v"])
    bad = spark.createDataFrame([("a", 2)], "k string, v long").withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        table.upsert(bad, 1, ["v"])
    assert [(r.k, r.v) for r in table.read().collect()] == [("a", 1)] and table.versions() == [0]


# --- audits -----------------------------------------------------------------------------------


def test_audits_after_every_batch_equal_the_whole_audit(spark):
    rng, base = random.Random(3), fresh_path(spark, "audit")
    schema = "txn_type string, txn_id string, party string, total_amt double, txn_date string"
    kinds, parts = ["Bill", "Deposit", "Payment"], []
    for b in range(3):
        part = [(rng.choice(kinds), f"{b}-{k}", rng.choice(["A", "B", None]), rng.choice([1.0, 2.0, None]), rng.choice(["2026-01-01", None])) for k in range(6 + 10 * b)]
        parts.append(part)
        put(spark, part, schema, f"{base}/in", b)
    audit = Audit(spark, f"{base}/audit", 4)
    ingest.start_batches(inbox(spark, f"{base}/in", schema), audit_sink(audit), f"{base}/state").awaitTermination()
    whole = lambda df: sorted(tuple(r) for r in df.select("txn_type", "strictness", "n_groups").collect())
    for b in range(3):
        so_far = spark.createDataFrame([r for p in parts[: b + 1] for r in p], schema)
        assert whole(audit.read(b)) == whole(duplicate_summary(so_far))
    audit.add(spark.createDataFrame(parts[2], schema), 2)  # a retried batch
    assert whole(audit.read()) == whole(duplicate_summary(spark.createDataFrame([r for p in parts for r in p], schema)))


# --- attachments apart from transactions ----------------------------------------------------------


def test_links_wait_for_partners_and_forget_them(spark):
    base, day = fresh_path(spark, "links"), dt.datetime(2026, 1, 1)
    at = lambda d: day + dt.timedelta(days=d)
    a_schema, t_schema = "message_id string, filename string, received_at timestamp", "message_id string, txn_id string, posted_at timestamp"
    a_parts = [
        [("m1", "a", at(0)), ("m2", "b", at(0.5)), (None, "n", at(0)), ("m9", "none", None)], [("m3", "c", at(1.4)), ("m1", "a2", at(1))],
        [("m4", "late", at(9))], [("end", "x", at(60))], [("end", "y", at(61))],
    ]
    t_parts = [
        [("m1", "t1", at(0.1))], [("m2", "t2", at(1)), ("m3", "t3", at(0.2))], [("m4", "t4", at(3)), ("m5", "t5", at(3))],
        [("end", "z", at(60))], [("end2", "z", at(61))],
    ]
    held = []
    for k, (a, t) in enumerate(zip(a_parts, t_parts)):
        put(spark, a, a_schema, f"{base}/a", k)
        put(spark, t, t_schema, f"{base}/t", k)
        stream = link_stream(inbox(spark, f"{base}/a", a_schema), inbox(spark, f"{base}/t", t_schema))
        query = ingest.start(stream, f"{base}/out", f"{base}/state")
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = {(r.message_id, r.filename, r.txn_id, r.status) for r in spark.read.parquet(f"{base}/out").collect()}
    assert {g for g in got if g[0] not in ("end", "end2")} == {
        ("m1", "a", "t1", "linked"), ("m1", "a2", "t1", "linked"), ("m2", "b", "t2", "linked"), ("m3", "c", "t3", "linked"),
        (None, "n", None, "rejected"), ("m4", "late", None, "rejected"), ("m4", None, "t4", "bare"), ("m5", None, "t5", "bare"),
    }
    assert held[-1] <= 5  # only what came last is still waited for


# --- reconciliation ---------------------------------------------------------------------------------


def gale_shapley(txns, bills, tolerance, days):
    """Transactions propose, bills keep whom they prefer; every preference follows the one order of pairs."""
    def rank(t, b):
        return (abs((t[3] - b[3]).days), abs(t[4] - b[4]), t[3], t[4], b[3], b[4], t[1], t[0], b[1], b[0])

    lists = {
        t[0]: sorted(
            (b for b in bills if None not in (*t[2:], *b[2:]) and t[2] == b[2] and abs(t[4] - b[4]) < tolerance and abs((t[3] - b[3]).days) <= days),
            key=lambda b: rank(t, b),
        )
        for t in txns
    }
    held, free = {}, list(txns)
    while free:
        t = free.pop()
        if not lists[t[0]]:
            continue
        b = lists[t[0]].pop(0)
        rival = held.get(b[0])
        if rival is None or rank(t, b) < rank(rival, b):
            held[b[0]] = t
            t = rival
        if t is not None:
            free.append(t)
    return {t[0]: b for b, t in held.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_reconciliation_equals_gale_shapley(spark, seed):
    rng, day = random.Random(seed), dt.date(2026, 1, 1)
    schema = "id string, ord long, party string, day date, amount double"

    def rows(prefix, n):
        return [(
            f"{prefix}{k}", rng.randrange(n), rng.choice(["A", "B", "C", None]),
            rng.choice([None] + [day + dt.timedelta(days=d) for d in range(6)]), rng.choice([None, 5.0, 5.004, 5.008, 5.012, 7.0, 7.0]),
        ) for k in range(n)]

    txns, bills = rows("t", 150), rows("b", 130)
    got = reconcile(
        spark.createDataFrame(txns, schema).withColumnRenamed("id", "txn_id").repartition(3),
        spark.createDataFrame(bills, schema).withColumnRenamed("id", "bill_id"), days=2,
    ).collect()
    assert len(got) == len(txns)
    assert {r.txn_id: r.bill_id for r in got if r.bill_id} == gale_shapley(txns, bills, 0.01, 2)


def test_many_copies_reconcile_by_number(spark):
    same = lambda name, n: spark.range(n).select(
        F.concat(F.lit(name[0]), "id").alias(f"{name}_id"), F.col("id").alias("ord"), F.lit("A").alias("party"),
        F.lit(dt.date(2026, 1, 1)).alias("day"), F.lit(5.0).alias("amount"),
    )
    got = reconcile(same("txn", 20_000), same("bill", 15_000)).collect()
    assert {r.txn_id: r.bill_id for r in got if r.bill_id} == {f"t{k}": f"b{k}" for k in range(15_000)}
    none = reconcile(same("txn", 3), same("bill", 0)).collect()
    assert [r.bill_id for r in none] == [None] * 3


def test_duplicate_sink_evaluates_a_batch_once(spark):
    base, plans = fresh_path(spark, "once"), []

    def check(batch, bills):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return batch.join(bills, "id").unionByName(batch)

    ingest.duplicate_sink(base, lambda: spark.range(3), check)(spark.range(5).filter("id > 1"), 0)
    assert "Scan parquet" in plans[0] and "Range" not in plans[0]
    assert sorted(r.id for r in ingest.read_checked(spark, base).collect()) == [2, 2, 3, 4]


def test_audit_counts_buckets_without_joining_the_batch(spark):
    audit = Audit(spark, fresh_path(spark, "audit-plan"), 4)
    rows = [("Bill", f"t{k}", float(k % 3), "2026-01-02", "A") for k in range(6)]
    for batch_id in range(2):
        audit.add(spark.createDataFrame(rows, "txn_type string, txn_id string, total_amt double, txn_date string, party string"), batch_id)
    counted = audit._counted(audit.groups.rewritten(1), 1)
    assert "Join" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in audit.read(0).sort("strictness").collect()] == [("Bill", "hard", 3), ("Bill", "soft", 3)]
    assert [tuple(r) for r in audit.read(1).sort("strictness").collect()] == [("Bill", "hard", 3), ("Bill", "soft", 3)]


def test_many_pages_take_few_tasks_and_appear_together(spark):
    groups = feed._groups(range(30_001), 4)
    assert len(groups) <= 256 and [p for g in groups for p in g.pages] == list(range(30_001))
    assert [g.pages for g in feed._groups(range(5), 2)] == [[0, 1], [2, 3], [4]]
    path = fresh_path(spark, "many")
    rows = spark.range(900).select(
        F.col("id").cast("string").alias("message_id"), F.when(F.col("id") % 2 == 0, "a\nb").alias("subject"),
        F.floor(F.col("id") / 3).alias("page"),
    )
    feed.write_pages(rows.repartition(5), path)
    # One file per page, and nothing of the writing is left in or beside the feed.
    assert sorted(os.listdir(path)) == sorted(f"page={k}" for k in range(300))
    assert {len(os.listdir(f"{path}/page={k}")) for k in range(300)} == {1}
    assert [f for f in os.listdir(os.path.dirname(path)) if f.startswith(os.path.basename(path) + ".")] == []
    feed.write_pages(rows.filter("page = 7").withColumn("message_id", F.lit("more")), path)  # added to a page that is there
    got = feed.read_feed(spark, path, "message_id string, subject string, page long")
    more = [("more", r.subject, 7) for r in rows.filter("page = 7").collect()]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [*map(tuple, rows.collect()), *more]))


def test_numbers_in_groups(spark):
    rows = [(k % 3 if k % 4 else None, k) for k in range(1000)]
    got = number_in_groups(spark.createDataFrame(rows, "g int, k int"), ["g"], ["k"]).collect()
    for g in (0, 1, 2, None):
        assert [r.number for r in sorted((r for r in got if r.g == g), key=lambda r: r.k)] == list(range(sum(x == g for x, _ in rows)))


# --- containment --------------------------------------------------------------------------------------


@pytest.mark.parametrize("most,common", [(containment.AUTOMATON_BYTES, 1000), (60, 2), (-1, 2), (-1, 1000)])
def test_containment_by_every_way(spark, monkeypatch, most, common):
    monkeypatch.setattr(containment, "AUTOMATON_BYTES", most)
    rng = random.Random(5)
    hosts = sorted({"".join(rng.choices("abcé", k=rng.randrange(1, 14))) for _ in range(250)})
    probes = sorted({"".join(rng.choices("abcé", k=rng.randrange(1, 6))) for _ in range(40)})
    h = spark.createDataFrame([(x, i) for i, x in enumerate(hosts)], "h string, ord int")
    p = spark.createDataFrame([(x, i) for i, x in enumerate(probes)], "p string, ord int")
    got = {r.p: r.ord for r in containment.first_host(p.select("p"), h, common).collect()}
    assert got == {x: min(i for i, y in enumerate(hosts) if x in y) for x in probes if any(x in y for y in hosts)}
    got = {r.h: r.ord for r in containment.first_probe_inside(p, h.select("h"), common).collect()}
    assert got == {y: min(i for i, x in enumerate(probes) if x in y) for y in hosts if any(x in y for x in probes)}
    assert containment.first_host(p.select("p").limit(0), h, common).collect() == []
    assert containment.first_probe_inside(p.limit(0), h.select("h"), common).collect() == []


def test_hot_probes_make_no_more_rows_than_hits(spark):
    hosts = spark.range(20_000).select(F.concat(F.lit("springfield "), "id").alias("h"), F.col("id").alias("ord"))
    probes = spark.createDataFrame([(f"field {k}",) for k in range(12)] + [("springfield",)], "p string")
    got = {r.p: r.ord for r in containment.first_host(probes, hosts).collect()}
    assert got == {f"field {k}": k for k in range(12)} | {"springfield": 0}
    assert json.dumps(got)
