"""Resolve the vendor and the customer of a draft against the master tables.

Every stage works on the distinct names or addresses and maps the answer back, and a
later stage only sees what the earlier ones left open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import address_key, blank, strip
from ..session import cut_lineage
from .containment import first_host, first_probe_inside
from .fuzzy import fuzzy_best
from .joins import best_per_key, first_per_key, keyed_join

VENDOR_THRESHOLD = 0.8
CUSTOMER_THRESHOLD = 0.7


def first_match(df: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """First row in scan order per key."""
    return first_per_key(df, keys, [order])


def best_match(df: DataFrame, keys: list[str], score: str, threshold: float, order: str = "ord") -> DataFrame:
    """Row with the highest score strictly above ``threshold`` per key, first on ties."""
    return best_per_key(df.filter(F.col(score) > threshold), keys, score, [order])


def _named(masters: DataFrame, id_column: str) -> DataFrame:
    return masters.select(
        F.col(id_column).alias("master_id"), "ord", F.col("display_name").alias("master_name")
    )


# --- vendors ---------------------------------------------------------------------


def vendor_exact(names: DataFrame, vendors: DataFrame) -> DataFrame:
    """Names (column ``name``) with the first vendor of equal stripped name, or nulls."""
    dimension = first_match(
        _named(vendors, "vendor_id").withColumn("key", strip(F.col("master_name"))), ["key"]
    ).drop("ord")
    keyed = names.withColumn("key", strip(F.col("name")))
    return keyed_join(keyed, dimension, ["key"], "left").drop("key")


def vendor_fuzzy(
    names: DataFrame, vendors: DataFrame, threshold: float = VENDOR_THRESHOLD
) -> DataFrame:
    """Most similar vendor per distinct name: name, master_id, master_name, ratio."""
    masters = _named(vendors, "vendor_id")
    best = fuzzy_best(
        names.select(F.col("name").alias("a")),
        masters.select(F.col("master_name").alias("b"), "ord"),
        threshold,
    )
    ids = masters.select("ord", "master_id")
    return keyed_join(best, ids, ["ord"], "inner").select(
        F.col("a").alias("name"), "master_id", F.col("b").alias("master_name"), "ratio"
    )


def resolve_vendors(
    drafts: DataFrame, vendors: DataFrame, threshold: float = VENDOR_THRESHOLD
) -> DataFrame:
    """Drafts with vendor_id, vendor_name and vendor_match (exact, fuzzy or new).

    A new vendor has no id yet and carries the draft's name as it is.
    """
    names = drafts.select(F.col("vendor_display_name").alias("name")).distinct()
    exact = cut_lineage(vendor_exact(names, vendors))
    rest = exact.filter(F.col("master_id").isNull()).select("name")
    fuzzy = vendor_fuzzy(rest, vendors, threshold)
    found = cut_lineage(
        exact.filter(F.col("master_id").isNotNull())
        .select("name", "master_id", "master_name", F.lit("exact").alias("kind"))
        .unionByName(fuzzy.select("name", "master_id", "master_name", F.lit("fuzzy").alias("kind")))
        .select(
            F.col("name").alias("vendor_display_name"),
            F.col("master_id").alias("vendor_id"),
            F.col("master_name").alias("vendor_name"),
            F.col("kind").alias("vendor_match"),
        )
    )
    return (
        keyed_join(drafts, found, ["vendor_display_name"], "left")
        .withColumn("vendor_name", F.coalesce("vendor_name", "vendor_display_name"))
        .withColumn("vendor_match", F.coalesce("vendor_match", F.lit("new")))
    )


# --- customers ---------------------------------------------------------------------


def customer_exact(names: DataFrame, customers: DataFrame) -> DataFrame:
    """Names (column ``name``) with the first customer of exactly that name, or nulls."""
    dimension = first_match(_named(customers, "customer_id"), ["master_name"]).drop("ord")
    dimension = dimension.withColumn("name", F.col("master_name"))
    return keyed_join(names, dimension, ["name"], "left")


def address_strings(customers: DataFrame, keep_blank: bool = False) -> DataFrame:
    """Distinct lower-cased billing and shipping addresses with the first owner's position."""
    keys = F.array_compact(
        F.array(
            *[
                F.when(F.col(a).isNotNull(), address_key(*[F.col(f"{a}.{p}") for p in ("line1", "line2", "city")]))
                for a in ("bill_addr", "ship_addr")
            ]
        )
    )
    rows = customers.select(F.explode(keys).alias("p"), "ord")
    if not keep_blank:
        rows = rows.filter(strip(F.col("p")) != "")
    return rows.groupBy("p").agg(F.min("ord").alias("ord"))


def customer_by_address(addresses: DataFrame, customers: DataFrame, **options) -> DataFrame:
    """First customer whose billing or shipping address contains the address or lies in it.

    ``addresses`` has the column ``address``; returns distinct address, master_id,
    master_name for those that match. Whitespace-only addresses match nothing.
    """
    wanted = addresses.select("address", F.lower(strip(F.col("address"))).alias("p")).distinct()
    wanted = cut_lineage(wanted.filter(F.col("p") != ""))
    if wanted.isEmpty():
        return _named(customers, "customer_id").select(F.lit("").alias("address"), "master_id", "master_name").limit(0)
    texts = wanted.select("p").distinct()
    masters = address_strings(customers)
    inside = first_host(texts, masters.withColumnRenamed("p", "h"), **options)
    around = first_probe_inside(masters, texts.withColumnRenamed("p", "h"), **options)
    first = (
        inside.unionByName(around.withColumnRenamed("h", "p"))
        .groupBy("p").agg(F.min("ord").alias("ord"))
    )
    owners = keyed_join(first, _named(customers, "customer_id"), ["ord"], "inner").drop("ord")
    return keyed_join(wanted, owners, ["p"], "inner").select("address", "master_id", "master_name")


def customer_fuzzy(
    addresses: DataFrame, customers: DataFrame, threshold: float = CUSTOMER_THRESHOLD
) -> DataFrame:
    """Customer whose lower-cased name is most similar to the lower-cased address."""
    wanted = addresses.select("address", F.lower(strip(F.col("address"))).alias("a")).distinct()
    masters = _named(customers, "customer_id")
    best = fuzzy_best(
        wanted.filter(F.col("a") != "").select("a"),
        masters.select(F.lower("master_name").alias("b"), "ord"),
        threshold,
    )
    owners = keyed_join(best, masters, ["ord"], "inner").select("a", "master_id", "master_name", "ratio")
    return keyed_join(wanted, owners, ["a"], "inner").select(
        "address", "master_id", "master_name", "ratio"
    )


def resolve_customers(
    drafts: DataFrame, customers: DataFrame, threshold: float = CUSTOMER_THRESHOLD
) -> DataFrame:
    """Drafts with customer_id, resolved_customer and customer_match.

    A given customer name is looked up exactly, without falling back to the
    address; only drafts without a name are matched by job site address.
    """
    by_name = customer_exact(
        drafts.filter(~blank(F.col("customer_name")))
        .select(F.col("customer_name").alias("name")).distinct(),
        customers,
    ).filter(F.col("master_id").isNotNull())
    # Written once, as every stage reads them again.
    addresses = cut_lineage(
        drafts.filter(blank(F.col("customer_name")) & ~blank(F.col("job_site_address")))
        .select(F.col("job_site_address").alias("address")).distinct()
    )
    contained = cut_lineage(customer_by_address(addresses, customers))
    rest = keyed_join(addresses, contained.select("address"), ["address"], "left_anti")
    similar = customer_fuzzy(rest, customers, threshold)

    # One lookup key per draft, so the drafts are joined once.
    keyed = drafts.withColumn("_by", F.when(~blank(F.col("customer_name")), "name").when(
        ~blank(F.col("job_site_address")), "address"
    )).withColumn("_key", F.coalesce(F.nullif("customer_name", F.lit("")), F.nullif("job_site_address", F.lit(""))))
    answers = cut_lineage(
        by_name.select(F.lit("name").alias("_by"), F.col("name").alias("_key"),
                       "master_id", "master_name", F.lit("name").alias("customer_match"))
        .unionByName(contained.select(F.lit("address").alias("_by"), F.col("address").alias("_key"),
                                      "master_id", "master_name", F.lit("address").alias("customer_match")))
        .unionByName(similar.select(F.lit("address").alias("_by"), F.col("address").alias("_key"),
                                    "master_id", "master_name", F.lit("fuzzy").alias("customer_match")))
        .withColumnRenamed("master_id", "customer_id")
        .withColumnRenamed("master_name", "resolved_customer")
    )
    return keyed_join(keyed, answers, ["_by", "_key"], "left").drop("_by", "_key")
