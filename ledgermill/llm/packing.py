"""Best-fit-decreasing packing of token sequences.

Documents are tokenised and cut in parallel. Pieces of one length are interchangeable, so the driver
packs the histogram of lengths (at most ``capacity`` numbers, however large the input) exactly as
best-fit decreasing packs the pieces one by one: a segment tree over remaining capacities finds
the tightest open sequence, for whole runs of equal pieces at a time. Executors then number the
pieces of each length and look their places up in the plan.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm import kernels as K
from ledgermill.llm.frames import cut as cut_table
from ledgermill.llm.frames import small_batches

CAPACITY = 2048
#: Pieces of one length that one task numbers.
_NUMBERED = 20_000

# --- tokens ---------------------------------------------------------------------------

# Texts with a character beyond this are given to the tokenizer whole.
_LATIN = 0x250
_LETTER, _NUMBER, _BLANK, _OTHER = range(4)
_BLANKS = {*range(9, 14), 0x20, 0x85, 0xA0}
_KIND = np.array(
    [
        _BLANK if c in _BLANKS
        else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)
        for c in range(_LATIN)
    ],
    np.int8,
)
_CODES = K.salt(_LATIN)
# Byte-level models write a byte that is no visible Latin character as one from 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
# Words a task remembers before it starts anew, which bounds its memory.
_REMEMBERED = 250_000


def split_points(chars: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern starts a new word, for texts that lie one after another.

    's 't 're 've 'm 'll 'd | ?letters | ?numbers | ?others | blanks but the last | blanks
    ``chars`` holds code points below ``_LATIN``, ``ends`` the end of each text.
    """
    n = len(chars)
    kind = _KIND[chars]
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[ends] = True
    text_start = np.zeros(n + 1, bool)
    text_start[0] = True
    text_start[ends] = True
    run = np.flatnonzero(start)[:-1] if n else np.zeros(0, int)
    run_end = np.append(run[1:], n)
    out = start.copy()
    blank = kind[run] == _BLANK
    follows = ~text_start[run_end]  # another run of the same text comes next
    w = blank & follows
    last = run_end[w] - 1
    # The last blank stands alone, or joins the next word if it is a space.
    out[last] = True
    spaced = chars[last] == 0x20
    out[run_end[w][spaced]] = False
    # A lone apostrophe and the letters of a contraction.
    lone = (kind[run] == _OTHER) & (run_end - run == 1) & follows
    lone &= chars[run] == 0x27
    at = run[lone]
    at = at[out[at]]  # not taken by a space
    at = at[kind[at + 1] == _LETTER]
    if len(at):
        one = chars[at + 1]
        after = np.minimum(at + 2, n - 1)
        two = np.where(start[at + 2], 0, chars[after])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(at), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        out[at[short | long] + 1] = False
        out[at[short] + 2] = True
        out[at[long] + 3] = True
    return np.flatnonzero(out[:n])


class Encoder:
    """Token ids of many texts; every different word is tokenised once per task."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        made_of = json.loads(self.tokenizer.to_str())
        before = made_of.get("pre_tokenizer") or {}
        # Words can be told apart here only where the tokenizer splits by the byte-level pattern.
        self.by_word = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and made_of.get("normalizer") is None
        )
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of each text's ids."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        if not self.by_word or len(chars) and chars.max() >= _LATIN:
            return self._mixed(texts, chars, ends)
        return self._latin("".join(texts), chars, ends)

    def _mixed(self, texts, chars, ends) -> tuple[np.ndarray, np.ndarray]:
        far = np.concatenate(([0], np.cumsum(chars >= _LATIN)))
        odd = (far[ends] > far[np.concatenate(([0], ends[:-1]))]) | (not self.by_word)
        near = [t for t, o in zip(texts, odd) if not o]
        ids, counts = self.encode(near)
        parts, at = iter(np.split(ids, np.cumsum(counts)[:-1]) if near else []), []
        for text, other in zip(texts, odd):
            if other:
                at.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                at.append(next(parts))
        return np.concatenate(at), np.array([len(x) for x in at], np.int64)

    def _latin(self, joined: str, chars, ends) -> tuple[np.ndarray, np.ndarray]:
        starts = split_points(chars, ends)
        stops = np.append(starts[1:], len(chars))
        hashes = K.run_hashes(chars, starts, stops, _CODES)
        unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == unique[inside]
        if not known.all():
            if len(self.hashes) > _REMEMBERED:
                self.forget()
                known[:] = False
            new = at[~known]
            tokenize = self.tokenizer.model.tokenize
            lists = [
                [t.id for t in tokenize(joined[a:b].encode().decode("latin-1").translate(_BYTE_CHARS))]
                for a, b in zip(starts[new].tolist(), stops[new].tolist())
            ]
            count = np.array([len(x) for x in lists], np.int64)
            first = len(self.ids) + np.cumsum(count) - count
            order = np.argsort(hashes := np.concatenate((self.hashes, unique[~known])), kind="stable")
            self.hashes = hashes[order]
            self.first = np.concatenate((self.first, first))[order]
            self.count = np.concatenate((self.count, count))[order]
            self.ids = np.concatenate((self.ids, np.array([i for x in lists for i in x], np.uint32)))
            place = np.searchsorted(self.hashes, unique)
        word = place[inverse]
        count, first = self.count[word], self.first[word]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        edge = np.searchsorted(starts, np.concatenate(([0], ends)))
        return ids, np.diff(total[edge])


def _pieces(path: str | None, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part in K.chunks(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, counts = encoder.encode(texts)
                ids = np.insert(ids, np.cumsum(counts), 0)  # id 0 ends a document
                counts = counts + 1
                first = np.concatenate(([0], np.cumsum(counts)))
                rows: dict[str, list] = {k: [] for k in ("owner", "piece", "start", "length", "crc", "ids")}
                for owner, n in enumerate(counts.tolist()):
                    start, piece = 0, 0
                    while start < n:
                        # Only the first piece of a longer document may be shorter.
                        length = (n - start) % capacity or capacity
                        value = ids[first[owner] + start : first[owner] + start + length]
                        rows["owner"].append(owner)
                        rows["piece"].append(piece)
                        rows["start"].append(start)
                        rows["length"].append(length)
                        rows["crc"].append(zlib.crc32(value.astype("<u4").tobytes()))
                        if with_ids:
                            rows["ids"].append(value.astype(np.int32))
                        start, piece = start + length, piece + 1
                columns = [
                    part.column("doc_id").cast(pa.int64()).take(pa.array(rows["owner"], pa.int64())),
                    pa.array(rows["piece"], pa.int32()),
                    *[pa.array(rows[k], pa.int64()) for k in ("start", "length", "crc")],
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(K.ragged(rows["ids"], pa.int32()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenised documents, each ended by id 0; longer ones cut, the first piece taking the rest.

    A null text counts as empty and yields one piece that holds only id 0.
    """
    texts = small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return texts.mapInArrow(
        K.tidy(_pieces(path, capacity, with_ids)), schema + (", ids array<int>" if with_ids else "")
    )


# --- plan -----------------------------------------------------------------------------


class Tightest:
    """Segment tree over remaining capacities that says which have an open sequence."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, c: int, is_open: bool) -> None:
        c += self.leaves
        self.open[c] = is_open
        while c > 1:
            c //= 2
            self.open[c] = self.open[2 * c] or self.open[2 * c + 1]

    def at_least(self, c: int) -> int | None:
        """The smallest capacity of ``c`` or more with an open sequence."""
        c += self.leaves
        if self.open[c]:
            return c - self.leaves
        while c > 1:
            if c % 2 == 0 and self.open[c + 1]:
                c += 1
                break
            c //= 2
        else:
            return None
        while c < self.leaves:
            c = 2 * c if self.open[2 * c] else 2 * c + 1
        return c - self.leaves


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` pieces per length.

    Returns runs (length, first, until, sequence, per, offset): piece number r of that length, first <= r <
    until, goes to sequence + (r - first) // per, at offset + (r - first) % per * length.
    """
    bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    tree, opened, runs = Tightest(capacity), 0, []

    def put(c: int, first: int, n: int) -> None:
        if n and c:
            bins[c].append((first, n))
            if len(bins[c]) == 1:
                tree.set(c, True)

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        at, total = 0, counts[length]
        while at < total:
            c = tree.at_least(length)
            if c is None:
                c, n = capacity, -(-(total - at) // (capacity // length))
                first, opened = opened, opened + n
            else:
                first, n = bins[c].pop()
                if not bins[c]:
                    tree.set(c, False)
            per = c // length
            full = min(n, (total - at) // per)
            if full:
                runs.append((length, at, at + full * per, first, per, capacity - c))
                put(c - per * length, first, full)
                at += full * per
            some = min(total - at, per) if full < n else 0
            if some:
                runs.append((length, at, at + some, first + full, some, capacity - c))
                put(c - some * length, first + full, 1)
                at += some
            put(c, first + full + bool(some), n - full - bool(some))
    return runs


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece with its sequence_id and offset; sequences hold ``capacity`` tokens at most.

    Repeated rows and repeated or null doc_ids are packed like any others; an empty table gives no
    row. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    # Written once: the numbers below must not change when a task is run again.
    cut = cut_table(
        pieces(docs, path, capacity, with_ids).withColumn("row", F.monotonically_increasing_id())
    )
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    buckets = max(1, -(-max(counts.values(), default=0) // _NUMBERED))
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("row")
    numbered = (
        cut.withColumn("number", F.row_number().over(inside) - 1)
        .join(bases, ["length", "bucket"])
        .withColumn("number", F.col("number") + F.col("base"))
    )
    plan = spark.createDataFrame(
        best_fit(counts, capacity),
        "plan_length long, first long, until long, sequence long, per long, place long",
    )
    # The plan's size depends on the capacity only, not on the number of documents.
    placed = numbered.join(
        F.broadcast(plan),
        F.expr("length = plan_length and number >= first and number < until"),
    )
    step = F.col("number") - F.col("first")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    return placed.select(
        *names,
        (F.col("sequence") + F.floor(step / F.col("per"))).alias("sequence_id"),
        (F.col("place") + step % F.col("per") * F.col("length")).alias("offset"),
    )
