"""Masters are split up only where a probe may match them."""

import pytest

from ledgermill.operators import fuzzy, resolve
from ledgermill.operators.fuzzy import fuzzy_best


def _masters(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "ord long, b string").select("b", "ord")


def test_no_probe_splits_up_no_master(spark, monkeypatch):
    def split(*_):
        raise AssertionError("a side was split up")

    monkeypatch.setattr(fuzzy, "_tokens", split)
    for rows in ([], [(None,)]):
        found = fuzzy_best(spark.createDataFrame(rows, "a string"), _masters(spark, ["north works", "south works"]), 0.8)
        assert found.columns == ["a", "b", "ord", "ratio"] and found.collect() == []


def test_masters_of_other_lengths_are_not_split_up(spark, monkeypatch):
    split, seen = fuzzy._tokens, []

    def noted(strings, t):
        seen.append({r.s for r in strings.collect()})
        return split(strings, t)

    monkeypatch.setattr(fuzzy, "_tokens", noted)
    names = ["north works", "north work", "n", "", "a name much longer than any of the probes", None]
    found = fuzzy_best(spark.createDataFrame([("north worka",)], "a string"), _masters(spark, names), 0.8)
    assert [(r.b, r.ord) for r in found.collect()] == [("north work", 1)]
    assert seen[1] == {"north works", "north work"}


@pytest.mark.parametrize("probes, best", [([""], [("", "")]), (["", "ab"], [("", ""), ("ab", "ab")])])
def test_empty_strings_still_match(spark, probes, best):
    found = fuzzy_best(spark.createDataFrame([(p,) for p in probes], "a string"), _masters(spark, ["", "ab", "abcd"]), 0.8)
    assert sorted((r.a, r.b) for r in found.collect()) == best


def test_no_address_reads_no_masters(spark, monkeypatch):
    def read(*_):
        raise AssertionError("addresses of masters were read")

    monkeypatch.setattr(resolve, "address_strings", read)
    address = "struct<line1: string, line2: string, city: string>"
    customers = spark.createDataFrame(
        [("c1", 1, "Ann", ("1 Main St", None, "Paris"), None)],
        f"customer_id string, ord long, display_name string, bill_addr {address}, ship_addr {address}",
    )
    for rows in ([], [("  ",)], [(None,)]):
        found = resolve.customer_by_address(spark.createDataFrame(rows, "address string"), customers)
        assert found.columns == ["address", "master_id", "master_name"] and found.collect() == []
