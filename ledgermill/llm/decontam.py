"""Benchmark decontamination by canonical templates.

Numbers, units after numbers, and names inside a sentence become typed placeholders; what is left is
lower-cased and stripped of punctuation. Windows of eight template words are joined by hash. Where a window holds a
capitalised word that begins a sentence, it is also joined with that word as a name, and all windows are also
joined as they are, lower-cased and with their values, so a copy in other case is found.
In a matching window the item's slots and the document's must map one to one; names must do so over all windows of one
document and item that lie on one alignment, and windows with a name that does not are left out. So a
re-parameterised question is caught, while text that only shares the shape of one is not. A document is
contaminated by an item if consistent windows cover at least half of the item's. An item of fewer than five words
counts only where it is a whole sentence, line or text, since such words stand together in much clean text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import kernels as K
from ledgermill.llm.frames import bitmap_of, cut, small_batches

#: Words of a window; of a shorter item all its words are one window. Windows with fewer than LITERAL words that
#: are no placeholders are matched as they are only, with their values, and items of fewer than SHORTEST words too,
#: as whole sentences.
WINDOW, LITERAL, SHORTEST = 8, 3, 5
#: Share of an item's windows that a contaminated document covers.
COVERED = 0.5
#: Bytes of text taken apart at a time: some hundred bytes are held per byte of it. A longer text is taken alone.
_CHUNK = 1 << 18

# Units of measure and money, read as such after a number.
_UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles g kg mg lb lbs pound pounds oz ounce ounces "
    "ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour "
    "hours day days week weeks month months year years percent degrees dollar dollars cent cents euro euros"
).split()

_INNER = np.zeros(256, bool)  # bytes that a word keeps at its ends
_INNER[48:58] = _INNER[65:91] = _INNER[97:123] = _INNER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWERED = K.salt(256)
_LOWERED[65:91] = _LOWERED[97:123]
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True

_NUMBER, _UNIT, _NAME, _EXACT = (np.uint64(x) for x in K.salt(68)[64:68])
#: Lowest two bits of a slot value by its kind; those of a literal are 0.
NUMBER_KIND, UNIT_KIND, NAME_KIND = 1, 2, 3


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return K.run_hashes(data, ends - [len(w) for w in words], ends, _LOWERED)


_UNIT_HASHES = np.sort(_hash_words(_UNITS))


class Words(NamedTuple):
    """Every word of some texts: template hash, slot value (0 for a literal), the same two with capitalised words that
    begin a sentence as names, lower-cased hash, text number, and whether the word begins a sentence, line or text."""

    hashes: np.ndarray
    slots: np.ndarray
    named_hashes: np.ndarray
    named_slots: np.ndarray
    values: np.ndarray
    owner: np.ndarray
    fresh: np.ndarray


def _index(data: np.ndarray) -> type:
    """The smaller kind of whole number that counts all bytes."""
    return np.int32 if len(data) < 1 << 31 else np.int64


def _counted(which: np.ndarray) -> np.ndarray:
    """How many hold before each place, and in all."""
    out = np.zeros(len(which) + 1, _index(which))
    np.cumsum(which, out=out[1:])
    return out


def templates(texts: pa.Array) -> Words:
    data, offsets = K.text_buffers(texts)
    # The capitals of Latin-1 end in 0x80 to 0x9E in UTF-8, their small letters 0x20 higher.
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    upper = _UPPER[data]
    upper[1:] |= capital
    data = data.copy()
    data[1:][capital] += 0x20
    starts, ends, owner = K.words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return Words(none, none, none, none, none, owner, np.zeros(0, bool))
    # Trim punctuation at both ends by the nearest inner byte.
    inner = _INNER[data]
    at = np.arange(len(data), dtype=_index(data))
    before = np.maximum.accumulate(np.where(inner, at, at.dtype.type(-1)))
    last = before[ends - 1].astype(np.int64) + 1
    del before
    after = np.minimum.accumulate(np.where(inner, at, at.dtype.type(len(data)))[::-1])[::-1]
    first = after[starts].astype(np.int64)
    del after, at
    kept = (first < ends) & (last > starts)
    stops = _STOP[data[ends - 1]]
    # A line break also starts a sentence; so does the beginning of a text.
    breaks = _counted(data == 10)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | stops[:-1] | (breaks[starts[1:]] > breaks[ends[:-1]])
    # What punctuation alone began still begins with the word after it.
    begun = np.cumsum(fresh)[kept]
    fresh = np.diff(begun, prepend=0) > 0
    starts, ends, owner = first[kept], last[kept], owner[kept]
    digits = _counted(_DIGIT[data])
    first_upper = upper[starts] | ((data[starts] == 0xC3) & upper[np.minimum(starts + 1, len(data) - 1)])
    small = _counted(_INNER[data] & ~_DIGIT[data] & ~upper & (data < 0x80))
    value = K.run_hashes(data, starts, ends, _LOWERED)
    number = digits[ends] > digits[starts]
    unit = np.isin(value, _UNIT_HASHES) & ~number
    unit[1:] &= number[:-1] & (owner[1:] == owner[:-1])
    unit[:1] = False
    # A capital with small letters after it, so also McDonald and Élise, but no words all in capitals.
    capital = first_upper & (small[ends] > small[starts]) & (ends - starts > 1) & ~number & ~unit

    def with_names(name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, kind = value.copy(), np.zeros(len(value), np.uint64)
        for which, said, k in ((number, _NUMBER, NUMBER_KIND), (unit, _UNIT, UNIT_KIND), (name, _NAME, NAME_KIND)):
            hashes[which], kind[which] = said, k
        return hashes, np.where(kind > 0, value & ~np.uint64(3) | kind, np.uint64(0))

    return Words(*with_names(capital & ~fresh), *with_names(capital), value, owner, fresh)


def _whole(words: Words, size: int) -> np.ndarray:
    """Whether each window of ``size`` words, within one text, is a whole sentence or line."""
    fresh = np.append(words.fresh, True)
    edge = np.append(words.owner[1:] != words.owner[:-1], True) if len(words.owner) else np.zeros(0, bool)
    ends = fresh[1:] | edge
    inner = np.concatenate(([0], np.cumsum(words.fresh)))
    n = len(words.owner) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    return words.fresh[:n] & ends[size - 1 :] & (inner[size:] - inner[:n] == 1)


_NONE = np.zeros(0, np.uint64)


def _enough(slots: np.ndarray, size: int) -> np.ndarray:
    """Whether each window of one text has enough literal words."""
    total = np.concatenate(([0], np.cumsum(slots == 0)))
    return total[size:] - total[:-size] >= min(LITERAL, size)


_WINDOW_ROW = "at int, hash long, slots array<long>"
_ITEM_ROW = "item_id long, size int, windows int, solid int, is_solid boolean, exact boolean"


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["item_id", "size", "windows", "solid", "is_solid", "exact"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_()]
    for batch in batches:
        for part in K.chunks(batch, "text", _CHUNK):
            words = templates(part.column("text"))
            edge = np.searchsorted(words.owner, np.arange(len(part) + 1))
            out: dict[str, list] = {k: [] for k in (*names, "at", "hash", "slots")}
            for k, item in enumerate(part.column("item_id").to_pylist()):
                w = Words(*(x[edge[k] : edge[k + 1]] for x in words))
                size = min(WINDOW, len(w.owner))
                if not size:
                    continue
                solid, named_solid = (_enough(x, size) & (size >= SHORTEST) for x in (w.slots, w.named_slots))
                usual, named = K.windows(w.hashes, size), K.windows(w.named_hashes, size)
                exact = K.windows(w.values, size) ^ _EXACT
                for found, which, slots in (
                    (usual, solid, w.slots), (named, named_solid & (named != usual), w.named_slots), (exact, np.ones(len(exact), bool), None)
                ):
                    for at in np.flatnonzero(which):
                        row = (item, size, len(exact), int(solid.sum()), bool(solid[at]), slots is None)
                        for name, value in zip(names, row):
                            out[name].append(value)
                        out["at"].append(int(at))
                        out["hash"].append(int(found[at].view(np.int64)))
                        out["slots"].append((_NONE if slots is None else slots[at : at + size]).view(np.int64))
            yield _window_batch([pa.array(out[n], k) for n, k in zip(names, kinds)], names, out)


def _window_batch(columns: list, names: list[str], out: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(out["at"], pa.int32()), pa.array(out["hash"], pa.int64()), K.ragged(out["slots"], pa.int64())],
        names=[*names, "at", "hash", "slots"],
    )


def _doc_windows(bits: np.ndarray, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text", _CHUNK):
                words = templates(part.column("text"))
                owner = words.owner
                keys = part.column("key").to_numpy(zero_copy_only=False)
                out: dict[str, list] = {k: [] for k in ("key", "at", "hash", "slots")}
                first = np.searchsorted(owner, np.arange(len(part)))
                for size in sizes:
                    usual, named = K.windows(words.hashes, size), K.windows(words.named_hashes, size)
                    inside = owner[: len(usual)] == owner[size - 1 :] if len(usual) else np.zeros(0, bool)
                    for found, which, slots in (
                        (usual, inside, words.slots), (named, inside & (named != usual), words.named_slots)
                    ):
                        for w in np.flatnonzero(which & K.may_contain(bits, found)):
                            out["key"].append(int(keys[owner[w]]))
                            out["at"].append(int(w - first[owner[w]]))
                            out["hash"].append(int(found[w].view(np.int64)))
                            out["slots"].append(slots[w : w + size].view(np.int64))
                    # Without slots there is no alignment to keep: once a text is enough.
                    exact = K.windows(words.values, size) ^ _EXACT
                    fits = inside & _whole(words, size) if size < SHORTEST else inside
                    for o, h in set(
                        (int(owner[w]), int(exact[w].view(np.int64)))
                        for w in np.flatnonzero(fits & K.may_contain(bits, exact))
                    ):
                        out["key"].append(int(keys[o]))
                        out["at"].append(0)
                        out["hash"].append(h)
                        out["slots"].append(_NONE.view(np.int64))
                yield _window_batch([pa.array(out["key"], pa.int64())], ["key"], out)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", covered: float = COVERED) -> DataFrame:
    """One row per document and item that contaminates it: key, item_id, windows, matched and coverage.

    ``key`` is a whole number that names the document; rows that share it count as one document, and rows where it
    is null are not looked at. Null or empty texts, items without a letter or digit, repeated rows and empty
    tables give no rows of their own. Extra columns are not read.
    """
    items = cut(
        benchmark.filter("item_id is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .distinct()
        .mapInArrow(K.tidy(_item_windows), f"{_ITEM_ROW}, {_WINDOW_ROW}")
    )
    # A bitmap of fixed size keeps windows that no item has out of the join; the join is exact.
    bits = bitmap_of(items.select("hash"))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    texts = small_batches(docs).select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    found = texts.filter("key is not null and text is not null").mapInArrow(
        K.tidy(_doc_windows(bits, sizes)), f"key long, {_WINDOW_ROW}"
    )
    item = ["item_id", "windows", "solid"]
    named = items.select(
        *item, "is_solid", "exact", F.col("at").alias("item_at"), F.col("hash").alias("item_hash"),
        F.col("slots").alias("item_slots"),
    )
    place = F.struct(F.col("item_at").alias("at"), "is_solid").alias("place")
    met = found.join(named, F.col("hash") == F.col("item_hash"))
    as_they_are = met.filter("exact").select("key", *item, place)
    pairs = F.array_distinct(F.filter(
        F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"] != 0
    ))
    one_to_one = (
        (F.size(F.array_distinct(F.col("pairs")["a"])) == F.size("pairs"))
        & (F.size(F.array_distinct(F.col("pairs")["b"])) == F.size("pairs"))
    )
    is_name = lambda p: p["a"].bitwiseAND(F.lit(NAME_KIND)) == NAME_KIND
    # The alignments of one document and item hold no more windows than the item has, and their names. Names are
    # gathered before windows that contradict themselves go, as these speak against a name too.
    aligned = (
        met.filter("not exact").withColumn("shift", F.col("at") - F.col("item_at")).withColumn("pairs", pairs)
        .withColumn("holds", one_to_one)
        .groupBy("key", *item, "shift")
        .agg(
            F.collect_set(F.struct(place, "holds", "pairs")).alias("met"),
            F.array_distinct(F.flatten(F.collect_set(F.filter("pairs", is_name)))).alias("names"),
        )
        .withColumn("wrong", F.filter("names", lambda n: F.exists(
            "names",
            lambda m: ((m["a"] == n["a"]) & (m["b"] != n["b"])) | ((m["b"] == n["b"]) & (m["a"] != n["a"])),
        )))
        .select("key", *item, "wrong", F.explode("met").alias("met"))
        .filter(F.col("met.holds") & ~F.arrays_overlap("met.pairs", "wrong"))
        .select("key", *item, "met.place")
    )
    # Windows of few literal words match as they are only, so coverage is that of the others if it is more.
    of_solid = F.coalesce(F.col("matched_solid") / F.nullif("solid", F.lit(0)) >= F.col("matched") / F.col("windows"), F.lit(False))
    return (
        aligned.unionByName(as_they_are).distinct()
        .groupBy("key", *item)
        .agg(F.count(F.lit(1)).alias("matched"), F.count_if("place.is_solid").alias("matched_solid"))
        .select(
            "key", "item_id", F.when(of_solid, F.col("solid")).otherwise(F.col("windows")).alias("windows"),
            F.when(of_solid, F.col("matched_solid")).otherwise(F.col("matched")).alias("matched"),
        )
        .withColumn("coverage", F.col("matched") / F.col("windows"))
        .filter(F.col("coverage") >= covered)
        .withColumnRenamed("key", key)
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """The documents that no item contaminates, with all their columns.

    Rows are numbered once and written with their numbers, so that they hold when executors are lost. Rows with a null text or doc_id are kept or judged like any others.
    """
    row = "_row_of_decontamination"
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    bad = contaminated(numbered.select(row, "text"), benchmark, row, covered).select(row).distinct()
    return numbered.join(bad, row, "left_anti").drop(row)
