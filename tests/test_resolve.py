import random

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.similarity import ratio
from ledgermill.operators.containment import first_host, first_probe_inside
from ledgermill.operators.fuzzy import fuzzy_best
from ledgermill.operators import fuzzy, resolve


def brute_best(probes, masters, t):
    out = {}
    for a in set(probes):
        best, best_ratio = None, t
        for ordinal, b in enumerate(masters):
            r = ratio(a, b)
            if r > best_ratio:
                best, best_ratio = ordinal, r
        if best is not None:
            out[a] = (masters[best], best, best_ratio)
    return out


def mutate(rng, s):
    s = list(s)
    for _ in range(rng.randint(0, 4)):
        i = rng.randrange(len(s) + 1)
        action = rng.choice("idr")
        if action == "i":
            s.insert(i, rng.choice("abcdexyz "))
        elif s and action == "d":
            s.pop(min(i, len(s) - 1))
        elif s:
            s[min(i, len(s) - 1)] = rng.choice("abcdexyz ")
    return "".join(s)


@pytest.mark.parametrize("t", [0.8, 0.7, 0.6])
def test_fuzzy_best_equals_brute_force(spark, t):
    rng = random.Random(7)
    words = ["acme", "home", "depot", "supplies", "inc", "garden", "aa", "b", "stone", "x"]
    masters = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(120)]
    masters += ["", "a", "ab", "aaa", "aaaa", "ba"]
    probes = [mutate(rng, rng.choice(masters)) for _ in range(150)] + ["", "a", "aab", "zzzz"]
    got = fuzzy_best(
        spark.createDataFrame([(p,) for p in probes], "a string"),
        spark.createDataFrame([(m, i) for i, m in enumerate(masters)], "b string, ord bigint"),
        t,
    ).collect()
    assert {r.a: (r.b, r.ord, r.ratio) for r in got} == brute_best(probes, masters, t)


def test_fuzzy_best_with_salted_tokens(spark):
    rng = random.Random(11)
    masters = [f"Supplier#{i:04d}" for i in range(60)]
    probes = [mutate(rng, m) for m in masters]
    got = fuzzy_best(
        spark.createDataFrame([(p,) for p in probes], "a string"),
        spark.createDataFrame([(m, i) for i, m in enumerate(masters)], "b string, ord bigint"),
        0.8, share=0.01, min_rows=5, force_salt=True,
    ).collect()
    assert {r.a: (r.b, r.ord, r.ratio) for r in got} == brute_best(probes, masters, 0.8)


@pytest.mark.parametrize("common", [0, 2, 1000])
def test_containment_equals_brute_force(spark, common):
    rng = random.Random(3)
    hosts = list({"".join(rng.choices("abc ", k=rng.randint(1, 12))) for _ in range(80)})
    probes = list({"".join(rng.choices("abc ", k=rng.randint(1, 5))) for _ in range(60)})
    hosts_df = spark.createDataFrame([(h, i) for i, h in enumerate(hosts)], "h string, ord bigint")
    probes_df = spark.createDataFrame([(p, i) for i, p in enumerate(probes)], "p string, ord bigint")
    want = {}
    for p in probes:
        found = [i for i, h in enumerate(hosts) if p in h]
        if found:
            want[p] = min(found)
    got = first_host(probes_df.select("p"), hosts_df, common)
    assert {r.p: r.ord for r in got.collect()} == want
    want = {}
    for h in hosts:
        found = [i for i, p in enumerate(probes) if p in h]
        if found:
            want[h] = min(found)
    got = first_probe_inside(probes_df, hosts_df.select("h"), common)
    assert {r.h: r.ord for r in got.collect()} == want


VENDORS = [("v1", 1, "Acme Supplies Inc"), ("v2", 2, "Home Depot "), ("v3", 3, "Home Depot"), ("v4", 4, "Acme Inc")]


def test_resolve_vendors(spark):
    vendors = spark.createDataFrame(VENDORS, "vendor_id string, ord bigint, display_name string")
    names = ["Acme Supplies", "  Home Depot", "Home Depot Inc", "Acme", "Brand New Co "]
    drafts = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "message_id string, vendor_display_name string")
    got = {r.vendor_display_name: (r.vendor_id, r.vendor_match, r.vendor_name) for r in resolve.resolve_vendors(drafts, vendors).collect()}
    assert got == {
        "Acme Supplies": ("v1", "fuzzy", "Acme Supplies Inc"),
        "  Home Depot": ("v2", "exact", "Home Depot "),
        "Home Depot Inc": ("v2", "fuzzy", "Home Depot "),
        "Acme": (None, "new", "Acme"),
        "Brand New Co ": (None, "new", "Brand New Co "),
    }
    assert ratio("Acme Supplies", "Acme Supplies Inc") == pytest.approx(0.8667, abs=1e-4)
    assert ratio("Acme", "Acme Inc") == pytest.approx(0.6667, abs=1e-4)


def test_resolve_customers(spark):
    schema = "customer_id string, ord bigint, display_name string, bill_addr struct<line1:string,line2:string,city:string>, ship_addr struct<line1:string,line2:string,city:string>"
    customers = spark.createDataFrame(
        [
            ("c1", 1, "Oak Residence", ("12 Oak Street", None, "Springfield"), None),
            ("c2", 2, "Elm Residence", ("9 Elm Road", "Unit 2", "Springfield"), ("1 Dock", None, "Harbor")),
            ("c3", 3, "Oak Residence", None, None),
            ("c4", 4, "500 Maple Avenue", None, None),
        ],
        schema,
    )
    drafts = spark.createDataFrame(
        [
            ("1", "Oak Residence", "9 Elm Road"),
            ("2", "oak residence", "9 Elm Road"),
            ("3", None, " 9 ELM Road "),
            ("4", "", "Springfield"),
            ("5", None, "deliver to 1 dock  harbor please"),
            ("6", None, "500 Maple Aven"),
            ("7", None, "77 Nowhere Lane"),
            ("8", None, "   "),
            ("9", None, None),
        ],
        "message_id string, customer_name string, job_site_address string",
    )
    got = {r.message_id: (r.customer_id, r.customer_match) for r in resolve.resolve_customers(drafts, customers).collect()}
    assert got == {
        "1": ("c1", "name"), "2": (None, None), "3": ("c2", "address"), "4": ("c1", "address"),
        "5": ("c2", "address"), "6": ("c4", "fuzzy"), "7": (None, None), "8": (None, None), "9": (None, None),
    }


def test_characters_of_a_string_are_listed_once_not_per_token(spark):
    prefixes = spark.createDataFrame([("abc", "b", ["ab", "bc"])], "s string, kind string, prefix array<string>")
    plan = fuzzy._index(prefixes, "a")._jdf.queryExecution().optimizedPlan().toString()
    # Below the explode, which repeats a string per token.
    assert "Generate explode" in plan and "array_position" not in plan.split("Generate explode")[0]


def test_masters_are_not_sent_to_executors_because_of_an_estimate(spark):
    """A few probes meet many masters in both passes: what is broadcast is the probes' side."""
    masters = spark.range(3000).select(F.format_string("Customer#%09d", "id").alias("b"), F.col("id").alias("ord"))
    probes = spark.createDataFrame([("Customer#00000001x",), ("nobody at all",)], "a string")
    best = fuzzy.fuzzy_best(probes, masters, 0.7)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2  # both sides are read as written, none is a join still to be estimated
    assert [(r.a, r.ord) for r in best.collect()] == [("Customer#00000001x", 1)]
