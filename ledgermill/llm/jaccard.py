"""Exact n-gram Jaccard self-join: size-aware, heavy-light.

Two texts link when 100 * |A & B| >= 80 * |A | B| over their sets of distinct 5-word shingles.

* Texts with the same set form one class; the join works on classes.
* Small sets list all their subsets of the size that a partner must share. Sets of sizes s <= t
  that share a subset of ceil(4/9 (s + t)) shingles are linked, so these links need no check.
* Large sets are found by scanning inverted lists. A list holds only the sets that have its
  shingle among their first s - ceil(0.8 s) + 1 in one global order; linked sets share one there.
  Shingles of long lists come last in that order, so texts that share a common passage meet
  only where the passage is nearly all they have.
* The boundary between small and large is the size with the least estimated number of rows.
* Within a list every set is first tried with one member only. Pairs that this leaves in
  different components are then all tried: a bound from parity sketches first, the exact
  intersection last. No pair that could still join two components goes untested.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import kernels as K
from ledgermill.llm.frames import bitmap_of, components, cut, drop, small_batches

#: A list with more members than this is long: its shingle goes to the end of the order.
LONG_LIST = 16
#: Sets up to this size are kept whole, and the boundary is looked for up to it.
LARGEST_SMALL = 24
#: Longs of the shortest sketch, and of the folded one that travels with the members of open lists.
_SMALL = 8
#: Cost of a row that is scanned and may need checking, in rows of a listed subset.
SCAN_COST = 4


def needed(s: int) -> int:
    """Shingles that a set of size s shares with any partner, at least."""
    return -(-4 * s // 5)


def needed_both(s: int, t: int) -> int:
    return -(-4 * (s + t) // 9)


def _kept(s: int) -> int:
    prefix = s - needed(s) + 1
    return s if s <= LARGEST_SMALL else min(s, prefix + prefix // 6 + 6)


def _sketch(x: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles per slot, as longs; a power of two of slots, at least one each."""
    bits = max(64 * _SMALL, 1 << (len(x) - 1).bit_length()) if len(x) else 64 * _SMALL
    slot = ((x.view(np.uint64) >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(slot, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


_SET_ROW = (
    "doc_id long, n_shingles long, node long, shingles array<long>, sketch array<long>"
)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in K.chunks(batch, "text"):
            sets = K.shingle_sets(part.column("text"))
            nodes, sizes = _node(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(sizes),
                    pa.array(nodes),
                    K.ragged([x[: _kept(len(x))] for x in sets], pa.int64()),
                    K.ragged([_sketch(x) for x in sets], pa.int64()),
                ],
                names=["doc_id", "n_shingles", "node", "shingles", "sketch"],
            )


def _node(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every whole set, and its size."""
    sizes = np.array([len(x) for x in sets], np.int64)
    total = np.array([K.mix(x.view(np.uint64)).sum(dtype=np.uint64) for x in sets], np.uint64)
    return K.mix(total + sizes.astype(np.uint64)).view(np.int64), sizes


def _whole_sets(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(K.may_contain(wanted, K.mix(ids.view(np.uint64)))))
            for part in K.chunks(batch, "text"):
                sets = K.shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_node(sets)[0]), K.ragged(sets, pa.int64())], names=["node", "shingles"]
                )

    return run


def _id_hash(ids: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in ids:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(K.mix(values.view(np.uint64)).view(np.int64))], names=["h"]
        )


def whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles): the whole sets of the classes in ``wanted`` (node, doc_id).

    A bitmap of fixed size keeps most other texts from being hashed; the join is exact.
    """
    bits = bitmap_of(wanted.select("doc_id").mapInArrow(K.tidy(_id_hash), "h long"))
    sets = texts.mapInArrow(K.tidy(_whole_sets(bits)), "node long, shingles array<long>")
    return sets.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def boundary(sizes: dict[int, int]) -> int:
    """Largest size treated as small, by the estimated rows of both ways."""

    def listed(s: int, limit: int) -> int:
        top = min(limit, 5 * s // 4)
        return sum(comb(s, needed_both(s, t)) for t in range(needed(s), top + 1))

    def cost(x: int) -> int:
        low = sum(n * listed(s, x) for s, n in sizes.items() if s <= x)
        lists = sum(
            n * (s - needed(s) + 1) for s, n in sizes.items() if needed(x + 1) <= s <= LARGEST_SMALL
        )
        return low + SCAN_COST * lists

    return min(range(LARGEST_SMALL + 1), key=cost)


def _subsets(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            for s in range(1, limit + 1):
                rows = np.flatnonzero(batch.column("n_shingles").to_numpy() == s)
                if not len(rows):
                    continue
                sets = np.stack(
                    [batch.column("shingles")[int(r)].values.to_numpy() for r in rows]
                ).view(np.uint64)
                for t in range(needed(s), min(limit, 5 * s // 4) + 1):
                    low, high = min(s, t), max(s, t)
                    picks = np.array(list(combinations(range(s), needed_both(s, t))))
                    for a in range(0, len(rows), max(1, 2_000_000 // picks.size)):
                        b = a + max(1, 2_000_000 // picks.size)
                        key = K.mix(
                            K.mix(sets[a:b])[:, picks].sum(axis=2, dtype=np.uint64)
                            + np.uint64(low << 8 | high)
                        )
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(key.ravel().view(np.int64)),
                                pa.array(np.repeat(nodes[rows[a:b]], len(picks))),
                                pa.array(np.full(key.size, s == low)),
                                pa.array(np.full(key.size, s == high)),
                            ],
                            names=["key", "node", "low", "high"],
                        )

    return run


def small_links(reps: DataFrame, limit: int) -> DataFrame:
    """Links (u, v) among sets up to ``limit``: sets sharing a listed subset, tied to one of them."""
    rows = reps.filter(F.col("n_shingles") <= limit).mapInArrow(
        K.tidy(_subsets(limit)), "key long, node long, low boolean, high boolean"
    )
    lists = (
        rows.groupBy("key")
        .agg(
            F.min("node").alias("v"), F.max("node").alias("last"),
            F.max("low").alias("low"), F.max("high").alias("high"),
        )
        .filter("low and high and v <> last")
    )
    return (
        rows.join(lists.select("key", "v"), "key")
        .filter("node <> v").select(F.col("node").alias("u"), "v").distinct()
    )


def _sizes_fit(a: Column, b: Column) -> Column:
    return F.greatest(a, b) * 4 <= F.least(a, b) * 5


def _half(sketch: Column) -> Column:
    """The same sketch with half as many slots."""
    n = F.size(sketch).cast("int")
    low, high = F.slice(sketch, F.lit(1), (n / 2).cast("int")), F.slice(sketch, (n / 2).cast("int") + 1, n)
    return F.zip_with(low, high, lambda a, b: a.bitwiseXOR(b))


def _differing(u: Column, v: Column) -> Column:
    """Slots in which two sketches differ; the longer one, twice as long at most, is halved first."""
    x = F.when(F.size(u) > F.size(v), _half(u)).otherwise(u)
    y = F.when(F.size(v) > F.size(u), _half(v)).otherwise(v)
    return F.aggregate(
        F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, z: total + z
    )


def _folded(sketch: Column) -> list[Column]:
    """A sketch folded to ``_SMALL`` longs, one column each."""
    times = (F.size(sketch) / _SMALL).cast("int")
    return [
        F.aggregate(
            F.sequence(F.lit(0), times - 1), F.lit(0).cast("long"),
            lambda acc, j: acc.bitwiseXOR(F.get(sketch, j * _SMALL + i)),
        ).alias(f"s{i}")
        for i in range(_SMALL)
    ]


def verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) of classes that link.

    The number of slots in which two parity sketches differ cannot exceed the number of shingles
    in one set only, so a large difference rules a pair out before whole sets are compared.
    """
    about = ("doc_id", "n_shingles", "sketch")

    def side(name: str) -> DataFrame:
        return reps.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in about])

    differ = _differing(F.col("u_sketch"), F.col("v_sketch"))
    sizes = F.col("u_n_shingles") + F.col("v_n_shingles")
    close = cut(
        pairs.join(side("u"), "u").join(side("v"), "v")
        .filter(_sizes_fit(F.col("u_n_shingles"), F.col("v_n_shingles")))
        .filter(differ * 9 <= sizes)
        .select("u", "v", "u_doc_id", "v_doc_id", "u_n_shingles", "v_n_shingles")
    )
    ends = F.array(*[F.struct(F.col(c).alias("node"), F.col(f"{c}_doc_id").alias("doc_id")) for c in "uv"])
    wanted = cut(close.select(F.inline(ends)).distinct())
    sets = cut(whole_sets(texts, wanted))
    linked = cut(close.join(
        sets.select(F.col("node").alias("u"), F.col("shingles").alias("u_set")), "u"
    ).join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("v_set")), "v")
    .filter(F.size(F.array_intersect("u_set", "v_set")) * 9 >= sizes * 4).select("u", "v"))
    drop(close, wanted, sets)
    return linked


#: Length of the part of a set that its partners must meet: s - needed(s) + 1.
_PREFIX = "n_shingles - (n_shingles * 4 + 4) div 5 + 1"


def list_rows(reps: DataFrame, texts: DataFrame, smallest: int) -> DataFrame:
    """(token, node, n_shingles, reread, own, center): members of the inverted lists.

    Long lists are told by an exact count. A set with a long list's shingle among its first ones
    takes later shingles instead; where those kept do not suffice, its whole set is read again. Two sets
    that were read again meet in lists of their own (``own``) only.
    """
    prefix = F.expr(_PREFIX)
    reps = reps.filter(F.col("n_shingles") >= smallest)
    rows = reps.select("node", "n_shingles", F.posexplode("shingles").alias("rank", "token"))
    shared = cut(rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    long_tokens = shared.filter(F.col("n") > LONG_LIST).select("token")
    touched = (
        rows.join(long_tokens, "token")
        .groupBy("node").agg(F.collect_list("rank").alias("long_ranks"))
        .join(reps.select("node", "doc_id", "n_shingles", F.size("shingles").alias("kept")), "node")
    )
    n_long = F.size("long_ranks")
    too_few = (F.col("kept") - n_long < prefix) & (F.col("kept") < F.col("n_shingles"))
    touched = cut(touched.withColumn("reread", too_few))
    again = touched.filter("reread").select("node", "doc_id", "n_shingles")
    full = cut(
        whole_sets(texts, again).join(again.drop("doc_id"), "node")
        .select("node", "n_shingles", F.explode("shingles").alias("token"))
    )
    # Among themselves the sets read again are ordered by exact frequency, in lists of their own.
    rare = full.groupBy("token").agg(F.count(F.lit(1)).alias("m"))
    by_length = F.sort_array(F.collect_list(F.struct(F.col("long").isNotNull().alias("long"), "token")))
    by_count = F.sort_array(F.collect_list(F.struct("m", "token")))
    first = lambda ranked: F.slice(ranked, F.lit(1), prefix.cast("int"))
    places = F.concat(
        F.transform(first("met"), lambda x: F.struct(x["token"].alias("token"), F.lit(False).alias("own"))),
        F.transform(
            F.filter(first("own"), lambda x: x["m"] > 1),
            lambda x: F.struct(F.xxhash64(x["token"], F.lit(1)).alias("token"), F.lit(True).alias("own")),
        ),
    )
    whole = cut(
        full.join(long_tokens.withColumn("long", F.lit(True)), "token", "left").join(rare, "token")
        .groupBy("node", "n_shingles").agg(
            by_length.alias("met"), by_count.alias("own"),
            # Share of shingles that others have too; the original of many edited copies has the most.
            F.avg((F.col("m") > 1).cast("double")).alias("center"),
        )
        .select("node", "n_shingles", "center", F.inline(places))
        .select("token", "node", "n_shingles", F.lit(True).alias("reread"), "own", "center")
    )
    drop(full)
    unseen = whole.filter("not own").select("token", F.lit(0).cast("long").alias("n"))
    tokens = shared.unionByName(unseen).groupBy("token").agg(F.max("n").alias("n"))
    met = (
        rows.join(tokens, "token")
        .join(touched.select("node", "long_ranks", "kept", "reread"), "node", "left")
        .filter("not coalesce(reread, false)")
    )
    ahead = F.size(F.filter(
        F.coalesce("long_ranks", F.array().cast("array<int>")), lambda r: r < F.col("rank")
    ))
    place = F.when(F.col("n") > LONG_LIST, F.col("kept") - n_long + ahead).otherwise(F.col("rank") - ahead)
    met = met.filter(place < prefix).select(
        "token", "node", "n_shingles", F.lit(False).alias("reread"), F.lit(False).alias("own"),
        F.lit(0.0).alias("center"),
    )
    lists = cut(met.unionByName(whole))
    drop(shared, touched, whole)
    return lists


def link_components(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of every class with a partner."""
    few = reps.filter(F.col("n_shingles") <= LARGEST_SMALL).groupBy("n_shingles").count().collect()
    limit = boundary({r["n_shingles"]: r["count"] for r in few})
    lists = list_rows(reps, texts, needed(limit + 1))

    heads = lists.groupBy("token").agg(
        F.max_by("node", F.struct("center", "node")).alias("v"),
        F.min("node").alias("first"), F.max("node").alias("last"),
    )
    met = (
        lists.join(heads.filter("first <> last").select("token", "v"), "token").filter("node <> v")
        .groupBy(F.col("node").alias("u"), "v").agg(F.count(F.lit(1)).alias("n"))
    )
    tries = met.groupBy("u").agg(F.max_by("v", F.struct("n", "v")).alias("v"))
    found = cut(verified(tries, reps, texts).unionByName(small_links(reps, limit)))
    parts = cut(components(found))

    placed = cut(
        lists.join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    open_lists = (
        placed.groupBy("token")
        .agg(F.min("component").alias("a"), F.max("component").alias("b"))
        .filter("a <> b").select("token")
    )
    small = reps.select("node", *_folded(F.col("sketch")))
    left_open = cut(placed.join(open_lists, "token").join(small, "node").drop("center"))
    other = left_open.select(
        "token", F.col("node").alias("v"), F.col("n_shingles").alias("v_n"),
        F.col("component").alias("v_component"), F.col("reread").alias("v_reread"),
        *[F.col(f"s{i}").alias(f"v_s{i}") for i in range(_SMALL)],
    )
    # Plain columns, since this is computed for every pair within a list.
    differ = F.lit(0)
    for i in range(_SMALL):
        differ = differ + F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"v_s{i}")))
    pairs = (
        left_open.withColumnRenamed("node", "u").join(other, "token")
        .filter("u < v and component <> v_component and (own or not (reread and v_reread))")
        .filter(_sizes_fit(F.col("n_shingles"), F.col("v_n")))
        .filter(differ * 9 <= F.col("n_shingles") + F.col("v_n"))
        .select("u", "v").distinct()
    )
    late = verified(pairs, reps, texts)
    joined = components(found.unionByName(late))
    drop(lists, parts, placed, left_open)
    return joined


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable).

    A null or empty text has no shingles and no partner. A row without doc_id is returned with a null
    component and links nothing. Repeated rows are returned as often as they occur. Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    texts = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    sets = cut(texts.mapInArrow(K.tidy(_describe), _SET_ROW))
    rows = cut(sets.select("doc_id", "n_shingles", "node"))
    usable = sets.filter("doc_id is not null and n_shingles > 0")
    # The row with the smallest id stands for its class; reduced before the shuffle.
    row = F.struct("doc_id", "n_shingles", "shingles", "sketch")
    reps = cut(
        usable.groupBy("node").agg(F.min_by(row, "doc_id").alias("row")).select("node", "row.*")
    )
    drop(sets)
    parts = cut(link_components(reps, texts.filter("doc_id is not null")))
    drop(reps)
    members = rows.join(parts, "node", "left")
    alone = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "node"))
    members = members.withColumn("label", alone)
    roots = members.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("root"))
    return members.join(roots, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    )
