"""Best fuzzy match above a threshold, exact although only few pairs are compared.

Let M be the number of characters an alignment of a and b matches and S = |a| + |b|.
ratio = 2M/S > t has three consequences that hold for every pair:

* length: the shorter string is longer than t/(2-t) times the other;
* characters: the bags of characters share more than t*S/2 of them;
* bigrams: M characters in k blocks hold M - k common bigrams, and between two
  blocks at least one character is unmatched, so k - 1 <= S - 2M. The
  bags of bigrams share at least 3M - S - 1, which is above (1.5t-1)S - 1.

When a pair must share c tokens, the |tokens| - c + 1 rarest tokens of both sides
have one in common (prefix filtering). So candidates come from an equi-join on rare
tokens, the bounds above are part of the join condition, and the similarity itself
runs only on pairs that can still win.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import bigrams, characters, ratio_bound, similarity
from ..session import cut_lineage, spread
from .joins import best_per_key, keyed_join

_EPS = 1e-9
# Partitions per core where strings are split up and their tokens put in order.
_PER_CORE = 4


def _bigram_floor(t: float) -> float:
    """Smallest |a| + |b| from which a match must share a bigram; infinite if none."""
    slope = 1.5 * t - 1
    return math.ceil(1 / slope) if slope > 0 else math.inf


def _tokens(strings: DataFrame, t: float) -> DataFrame:
    """Every token a string may be found by: (s, kind, token, n, need).

    ``n`` counts the string's tokens of that kind, ``need`` how many of them any match shares.
    """
    smallest_sum = F.length("s") * (2 / (2 - t))
    parts = []
    start = _bigram_floor(t)
    if start < math.inf:
        grams = bigrams(F.col("s"))
        need = F.floor((1.5 * t - 1) * smallest_sum - 1 - _EPS) + 1
        parts.append(
            strings.select(
                "s", F.lit("b").alias("kind"), grams.alias("all"),
                F.greatest(need, F.lit(1)).alias("need"),
            )
        )
    # A pair shorter than the floor shares characters, but maybe no bigram.
    # The empty string, which only equals itself, gets a token of its own.
    chars = F.when(F.length("s") == 0, F.array(F.lit("\x00"))).otherwise(characters(F.col("s")))
    need = F.floor(t / 2 * smallest_sum - _EPS) + 1
    short = strings if start == math.inf else strings.filter(smallest_sum < start + 1)
    parts.append(
        short.select(
            "s", F.lit("c").alias("kind"), chars.alias("all"),
            F.greatest(need, F.lit(1)).alias("need"),
        )
    )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # An outer explode: for an inner one the optimizer adds a filter on the array and
    # moves it down, which would build the array a second time below the distinct.
    rows = both.select(
        "s", "kind", F.size("all").alias("n"), "need", F.explode_outer("all").alias("token")
    )
    return rows.filter(F.col("token").isNotNull())


def _prefixes(tokens: DataFrame, frequency: DataFrame) -> DataFrame:
    """(s, kind, prefix): a string's rarest tokens, as many as the filter needs."""
    ranked = keyed_join(tokens, frequency, ["kind", "token"], "left").withColumn(
        # Sorts by frequency, then by token.
        "token", F.concat(F.lpad(F.col("df").cast("string"), 15, "0"), F.col("token"))
    )
    # Few bytes, but much work per string: a number of partitions that is not reduced to what the bytes call for.
    spread_out = ranked.repartition(_PER_CORE * ranked.sparkSession.sparkContext.defaultParallelism, "s")
    # One group is one string, so the collected list is as long as the string.
    grouped = spread_out.groupBy("s", "kind").agg(
        F.sort_array(F.collect_list("token")).alias("all"),
        F.first("n").alias("n"),
        F.first("need").alias("need"),
    )
    size = F.greatest((F.col("n") - F.col("need") + 1).cast("int"), F.lit(0))
    return grouped.select("s", "kind", F.slice("all", F.lit(1), size).alias("prefix"))


def _index(prefixes: DataFrame, side: str) -> DataFrame:
    # The characters in a step of their own: beside the explode they would be computed again for every token.
    strings = prefixes.select(
        F.col("s").alias(side), "kind", F.col("prefix").alias(f"{side}_prefix"), characters(F.col("s")).alias(f"{side}_chars")
    )
    return strings.select("*", F.explode(f"{side}_prefix").alias("token"))


def _length_ok(t: float) -> Column:
    a, b = F.length("a"), F.length("b")
    return F.least(a, b) > F.greatest(a, b) * (t / (2 - t)) - _EPS


def _pair_condition(t: float) -> Column:
    """Residual of the token join: bounds, and each pair at its first common token only."""
    start = _bigram_floor(t)
    total = F.length("a") + F.length("b")
    kind = F.lit(True) if start == math.inf else (F.col("kind") == "b") == (total >= start)
    first_common = F.array_min(F.array_intersect("a_prefix", "b_prefix")) == F.col("token")
    bound = ratio_bound(F.col("a_chars"), F.col("b_chars"))
    return kind & _length_ok(t) & first_common & (bound > t - _EPS)


def _indexed(probes: DataFrame, masters: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with one row per rare token, written to the shared folder; None if there is no probe.

    Masters that are too short or too long for every probe are left out before they are split up.
    """
    probes = spread(cut_lineage(probes))
    shortest, longest = probes.agg(F.min(F.length("a")), F.max(F.length("a"))).first()
    if shortest is None:
        return None
    share, size = threshold / (2 - threshold), F.length("b")
    masters = spread(cut_lineage(masters.filter((size > shortest * share - _EPS) & (size * share < longest + _EPS))))
    probe_tokens = cut_lineage(_tokens(probes.withColumnRenamed("a", "s"), threshold))
    master_tokens = cut_lineage(_tokens(masters.select(F.col("b").alias("s")), threshold))
    # How rare a token is among the masters decides how many rows a probe meets.
    frequency = (
        master_tokens.select("kind", "token", F.lit(1).alias("m"))
        .unionByName(probe_tokens.select("kind", "token", F.lit(0).alias("m")))
        .groupBy("kind", "token").agg(F.sum("m").alias("df"))
    )
    left = cut_lineage(_index(_prefixes(probe_tokens, frequency), "a"))
    right = cut_lineage(
        keyed_join(_index(_prefixes(master_tokens, frequency), "b"), masters, ["b"], "inner")
    )
    return left, right


def _no_pairs(masters: DataFrame) -> DataFrame:
    return masters.select(
        F.lit("").alias("a"), "b", "ord", F.lit(0.0).alias("ratio")
    ).limit(0)


def similar_pairs(
    probes: DataFrame, masters: DataFrame, threshold: float, **join_options
) -> DataFrame:
    """All (a, b, ord, ratio) with a ratio above ``threshold``.

    For master sets whose members are unlike one another, where a probe has few hits.
    """
    indexed = _indexed(probes, masters, threshold)
    if indexed is None:
        return _no_pairs(masters)
    left, right = indexed
    pairs = keyed_join(
        left, right, ["kind", "token"], "inner", residual=_pair_condition(threshold), **join_options
    )
    scored = pairs.select("a", "b", "ord").withColumn("ratio", similarity("a", "b"))
    return scored.filter(F.col("ratio") > threshold)


def fuzzy_best(
    probes: DataFrame, masters: DataFrame, threshold: float, **join_options
) -> DataFrame:
    """Best master per probe: (a, b, ord, ratio).

    ``probes`` has the column ``a``; ``masters`` has ``b`` and ``ord``. Only ratios strictly
    above ``threshold`` count; the highest wins, the smallest ``ord`` on ties.
    """
    probes = probes.select("a").distinct()
    masters = masters.groupBy("b").agg(F.min("ord").alias("ord"))
    indexed = _indexed(probes, masters, threshold)
    if indexed is None:
        return _no_pairs(masters)
    left, right = indexed
    bound = ratio_bound(F.col("a_chars"), F.col("b_chars"))
    condition = _pair_condition(threshold)
    # Pass 1: the most promising master per probe. The join feeds a partial
    # aggregate, so pairs are not shuffled; one similarity call per probe.
    pairs = keyed_join(left, right, ["kind", "token"], "inner", residual=condition, **join_options)
    seeds = best_per_key(pairs.select("a", "b", "ord", bound.alias("bound")), ["a"], "bound", ["ord"])
    seeds = seeds.select("a", similarity("a", "b").alias("reached"))
    reached = cut_lineage(seeds.withColumn("reached", F.greatest("reached", F.lit(threshold))))
    # Pass 2: only pairs whose bound is not below what the probe has reached. Written out, so that the side sent to
    # all executors is chosen by real sizes: an estimate of this join is large, and the masters would be sent.
    hopeful = cut_lineage(keyed_join(left, reached, ["a"], "inner"))
    pairs = keyed_join(
        hopeful, right, ["kind", "token"], "inner",
        residual=condition & (bound >= F.col("reached") - _EPS), profile=left, **join_options,
    )
    scored = pairs.select("a", "b", "ord").withColumn("ratio", similarity("a", "b"))
    return best_per_key(scored.filter(F.col("ratio") > threshold), ["a"], "ratio", ["ord"])
