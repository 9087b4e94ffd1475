"""Equi-joins that hold when one key owns a large share of the rows.

How a join is carried out is the planner's choice: it broadcasts a side below the session's
threshold, and adaptive execution splits a partition that turns out skewed. Where hot keys on both sides
are expected from the start (``force_salt``), a bounded sketch names them and a salt spreads them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy when it holds more than this share of the rows and also more than
# HEAVY_ROWS rows. At most 1 / HEAVY_SHARE keys can qualify, which bounds the list
# of heavy keys (16 bytes each) that is broadcast. A heavy key gets as many salts as
# it holds such shares, so no salted group exceeds one share of the rows.
HEAVY_SHARE = 0.0001
HEAVY_ROWS = 1_000_000
_TRACKED = 65_536
# Keys are sketched in so many groups by their hash, so that no single task merges all sketches.
_SHARDS = 64


def heavy_keys(
    df: DataFrame, key_hash: Column, share: float = HEAVY_SHARE, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Hash and salt count of keys that hold more than about ``share`` of the rows.

    One pass with a constant-size frequent-items sketch per task and shard; keys are not shuffled. A
    shard's rows stand for its part of the table, so a shard with a very hot key lists fewer others. The
    sketch only decides where rows go, never what the join returns.
    """
    shards = max(1, min(_SHARDS, int(0.1 / share)))
    shard_share = share * shards
    top = (
        df.select(key_hash.alias("h")).groupBy(F.pmod("h", F.lit(shards)).alias("shard"))
        .agg(
            F.expr(f"approx_top_k(h, {int(1 / shard_share)}, {_TRACKED // shards})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    least = F.lit(shard_share) * F.col("n")
    return (
        top.select("n", F.inline("top"))
        .filter((F.col("count") > least) & (F.col("count") > min_rows))
        .select(F.col("item").alias("heavy_hash"), F.ceil(F.col("count") / least).alias("salts"))
    )


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    residual: Column | None = None,
    null_safe: bool = False,
    profile: DataFrame | None = None,
    share: float = HEAVY_SHARE,
    min_rows: int = HEAVY_ROWS,
    force_salt: bool = False,
) -> DataFrame:
    """Join ``left`` to ``right`` on equal columns ``on``; either side may be skewed.

    ``how`` is inner, left, left_semi or left_anti. Key columns of the result come from the left. With
    ``null_safe`` two nulls are equal. With ``force_salt`` the rows of a heavy key are spread by the hash of
    their columns (on the left: of ``spread``, default all) and the number of the input partition, so copies of
    one row are spread too and a retried task repeats its choice. The other side is repeated per
    salt, for heavy keys only. Keys that are heavy on the right are spread in inner joins. ``profile`` is a
    cheaper frame with the left side's key columns to look for heavy keys in.
    """
    tag = uuid.uuid4().hex[:8]
    key_names = {k: f"_k_{k}_{tag}" for k in on}
    right = right.withColumnsRenamed(key_names)

    def equal(k: str) -> Column:
        a, b = F.col(k), F.col(key_names[k])
        return a.eqNullSafe(b) if null_safe else a == b

    condition = equal(on[0])
    for k in on[1:]:
        condition = condition & equal(k)
    if residual is not None:
        condition = condition & residual
    salts: list[str] = []
    if force_salt:
        left, right, name = _salted(
            left, right, on, list(key_names.values()), left if profile is None else profile,
            spread or left.columns, share, min_rows, f"l_{tag}",
        )
        salts.append(name)
        if how == "inner":
            keys = list(key_names.values())
            right, left, name = _salted(
                right, left, keys, on, right, [c for c in right.columns if c not in salts], share, min_rows, f"r_{tag}",
                renamed=True,
            )
            salts.append(name)
        for name in salts:
            condition = condition & (F.col(name) == F.col(f"{name}_"))
    joined = left.join(right, condition, how)
    return joined.drop(*salts, *[f"{name}_" for name in salts], *key_names.values())


def _salted(hot, other, hot_keys, other_keys, source, spread, share, min_rows, tag, renamed=False):
    """``hot`` with a salt per row, and ``other`` repeated for every salt of its key."""
    name, hashed, count = f"_s{tag}", f"_h{tag}", f"_n{tag}"
    heavy = heavy_keys(source, F.xxhash64(*hot_keys), share, min_rows)
    heavy = F.broadcast(heavy.toDF(hashed, count))  # at most 1 / share keys
    salts = F.coalesce(count, F.lit(1).cast("bigint"))
    first, second = (f"{name}_", name) if renamed else (name, f"{name}_")
    hot = (
        hot.join(heavy, F.xxhash64(*hot_keys) == F.col(hashed), "left")
        # Reduced first, so that adding the partition cannot overflow.
        .withColumn(first, F.pmod(F.pmod(F.xxhash64(*spread), salts) + F.spark_partition_id(), salts))
        .drop(hashed, count)
    )
    other = (
        other.join(heavy, F.xxhash64(*other_keys) == F.col(hashed), "left")
        .withColumn(second, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
        .drop(hashed, count)
    )
    return hot, other, name


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes first in ``order`` for every key.

    An aggregate, so rows are reduced before the shuffle however many share a key.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*others)
    picked = df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def best_per_key(
    df: DataFrame, keys: Sequence[str], score: str, order: Sequence[str]
) -> DataFrame:
    """The row with the highest ``score`` per key; the first in ``order`` on ties."""
    others = [c for c in df.columns if c not in keys]
    rank = F.struct((-F.col(score)).alias("s"), *[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in others])
