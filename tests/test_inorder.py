"""Batches posted at once against a draft-by-draft reference."""

import random

import pytest

from ledgermill.functions.similarity import ratio
from ledgermill.operators.inorder import post_in_order

DRAFTS = (
    "message_id string, arrival bigint, vendor_display_name string, invoice_number string, "
    "invoice_date string, total_amount double, lines_total double, is_receipt boolean"
)
BILLS = "bill_id string, ord bigint, vendor_name string, txn_date string, doc_number string, total double"
VENDORS = "vendor_id string, ord bigint, display_name string"


def iso(day):
    if day and "/" in day:
        month, date, year = day.split("/")
        return f"{year}-{int(month):02d}-{int(date):02d}"
    return day


def one_by_one(drafts, bills, vendors):
    posted = [dict(id=b[0], vendor=b[2], date=b[3], number=b[4], total=b[5]) for b in sorted(bills, key=lambda b: b[1])]
    known = [v[2] for v in sorted(vendors, key=lambda v: v[1])]
    out = {}
    for mid, _, vendor, number, day, total, lines, is_receipt in sorted(drafts, key=lambda d: d[1]):
        day = iso(day)
        hit = None
        if not is_receipt:
            for b in posted:
                if number and b["number"] and number == b["number"]:
                    hit = b
                elif total is not None and b["vendor"] == vendor and b["date"] == day and abs(b["total"] - total) < 0.01:
                    hit = b
                if hit:
                    break
        if hit:
            out[mid] = ("duplicate", hit["id"], None)
            continue
        if total is None or total <= 0:
            out[mid] = ("rejected", None, None)
            continue
        chosen = next((k for k in known if k.strip() == vendor.strip()), None)
        if chosen is None:
            best = 0.8
            for k in known:
                if ratio(vendor, k) > best:
                    best, chosen = ratio(vendor, k), k
        if chosen is None:
            chosen = vendor
            known.append(vendor)
        out[mid] = ("created", None, chosen)
        if not is_receipt:
            posted.append(dict(id=mid, vendor=chosen, date=day, number=number, total=lines))
    return out


def run(spark, drafts, bills, vendors):
    rows = post_in_order(
        spark.createDataFrame(drafts, DRAFTS), spark.createDataFrame(bills, BILLS), spark.createDataFrame(vendors, VENDORS)
    ).collect()
    assert len(rows) == len(drafts)
    return {r.message_id: (r.status, r.duplicate_of, r.vendor_name) for r in rows}


def test_tolerance_chain(spark):
    drafts = [(str(i), i, "Acme", "", "03/05/2026", amount, amount, False) for i, amount in enumerate([100.0, 100.009, 100.018])]
    got = run(spark, drafts, [], [])
    assert [got[str(i)][0] for i in range(3)] == ["created", "duplicate", "created"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches(spark, seed):
    rng = random.Random(seed)
    names = ["Acme Supplies", "Acme Supplies Inc", "Acme Supply", " Acme Supplies", "Acme Suppliers Inc.", "Home Depot", "Home Depots", "Zed"]
    vendors = [("v0", 0, "Home Depot "), ("v1", 1, "Zebra")]
    amount = lambda: rng.choice([100.0, 100.006, 100.012, 250.0, None, 0.0, 100.0])
    bills = [(f"b{i}", i, rng.choice(names), "2026-03-05", rng.choice(["", "N1", "N2", None]), 250.0) for i in range(2)]
    drafts = []
    for i in range(40):
        total = amount()
        lines = total if total and rng.random() < 0.8 else 100.0
        drafts.append((
            f"m{i}", i, rng.choice(names), rng.choice(["", None, "N1", "N3", "N4", "N5", f"U{i}", f"U{i}"]),
            rng.choice(["03/05/2026", "3/5/2026", "2026-03-05", None, "03/06/2026"]), total, lines, rng.random() < 0.25,
        ))
    assert run(spark, drafts, bills, vendors) == one_by_one(drafts, bills, vendors)
