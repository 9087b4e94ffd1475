"""Ranked lexical search over impact vectors in norm buckets.

A document is a vector of impacts, one per query term it holds; a query is a vector of term weights; the score is
their inner product. Vectors are ordered by length and cut into buckets. With the score of the k-th best document so
far as threshold, a bucket is skipped when query length times its greatest vector length stays below it
(Cauchy-Schwarz). Inside a bucket the exact products over the heaviest query terms plus Cauchy-Schwarz over
the other coordinates bound each document. Documents whose bound reaches the threshold are scored in 64-bit
integers. Bounds are computed in doubles, with a margin above their rounding; scores never are.

Queries are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.frames import cut, drop

K = 50
#: Queries, and bytes of their texts, that one pass over the documents answers; further ones take another pass.
BLOCK_QUERIES, BLOCK_BYTES = 5_000, 4 << 20
#: Documents whose scores give the first thresholds: the longest vectors, about so many.
SEEDS = 20_000
#: Vectors of one bucket at most.
BUCKET = 2048
# Share of a query's squared length that the coordinates looked at inside a bucket hold, at least.
_FOCUS = 0.9
# Above the rounding of sums of a few thousand doubles.
_MARGIN = 1 + 1e-9
_TEXTS = 256

# A-Z lower-cased, digits and all bytes of other characters kept, everything else a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, of a text in UTF-8."""
    return text.translate(_FOLD).split()


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, term list, tf list) per document with a term: all its terms counted, those of ``vocabulary`` listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                n, numbers, counts, ends = [], [], [], [0]
                for data in batch.column(1).slice(at, _TEXTS).to_pylist():
                    words = terms(data)
                    n.append(len(words))
                    found = Counter(words)
                    here = found.keys() & known.keys()
                    numbers.extend(map(known.__getitem__, here))
                    counts.extend(map(found.__getitem__, here))
                    ends.append(len(numbers))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, _TEXTS), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ], names=["key", "n", "terms", "tfs"])

    rows = docs.select(
        F.struct(F.col(key).alias("id")).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    key_type = rows.schema["key"].dataType.simpleString()
    made = rows.mapInArrow(counted, f"key {key_type}, n long, terms array<int>, tfs array<int>")
    return made.filter("n > 0").select(F.col("key.id").alias("key"), "n", "terms", "tfs")


@dataclass(frozen=True)
class Statistics:
    """Counts over all documents: documents and terms, and documents per term of the vocabulary."""

    documents: int
    total: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        n = self.documents
        return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in self.df], np.int64)


def statistics(counts: DataFrame, size: int) -> Statistics:
    """The driver gets one number per term of the vocabulary, whose size the query blocks bound."""
    whole = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(size, np.int64)
    found = counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("t").alias("df")).toPandas()
    df[found["t"]] = found["df"]
    return Statistics(whole[0], whole[1] or 0, df)


def impact_vectors(counts: DataFrame, stats: Statistics) -> DataFrame:
    """(key, norm, term list, impact list) of documents that hold a query term, longest first in each partition."""
    documents, total = stats.documents, stats.total

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, numbers, tfs = batch.columns
            ends = numbers.offsets.to_numpy().astype(np.int64)
            size, ends = np.diff(ends), ends - ends[0]
            tf = tfs.flatten().to_numpy().astype(np.int64)
            m = 100 - 50 + (50 * n.to_numpy() * documents) // total
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size))
            squares = np.add.reduceat(np.append(impact.astype(np.float64) ** 2, 0.0), ends[:-1])
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                keys, pa.array(np.sqrt(squares)), pa.ListArray.from_arrays(offsets, numbers.flatten()),
                pa.ListArray.from_arrays(offsets, pa.array(impact)),
            ], names=["key", "norm", "terms", "impacts"])

    rows = counts.filter(F.size("terms") > 0).select(F.struct("key").alias("key"), "n", "terms", "tfs")
    key_type = rows.schema["key"].dataType.simpleString()
    made = rows.mapInArrow(weighed, f"key {key_type}, norm double, terms array<int>, impacts array<long>")
    return made.select("key.key", "norm", "terms", "impacts").sortWithinPartitions(F.desc("norm"))


class Bucket:
    """Vectors of similar length, by document and by term."""

    def __init__(self, norms: np.ndarray, size: np.ndarray, numbers: np.ndarray, impacts: np.ndarray):
        self.norms, self.size = norms, size
        self.longest = norms.max() * _MARGIN
        self.numbers, self.impacts = numbers, impacts
        self.starts = np.cumsum(size) - size
        order = np.argsort(numbers, kind="stable")
        by_term = numbers[order]
        self.docs = np.repeat(np.arange(len(size)), size)[order]
        self.term_impacts = impacts[order]
        self.present, first = np.unique(by_term, return_index=True)
        self.first = np.append(first, len(by_term))

    def listed(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.present, term)
        if at == len(self.present) or self.present[at] != term:
            return self.docs[:0], self.term_impacts[:0]
        part = slice(self.first[at], self.first[at + 1])
        return self.docs[part], self.term_impacts[part]

    def may_reach(self, query: Query, threshold: int) -> np.ndarray:
        """Documents whose score may be ``threshold`` or more."""
        if query.length * self.longest < threshold:
            return np.zeros(0, np.int64)
        known = np.zeros(len(self.norms))
        rest = self.norms**2
        for term, weight in zip(query.focus, query.focus_weights):
            docs, impacts = self.listed(term)
            known[docs] += weight * impacts
            rest[docs] -= impacts.astype(np.float64) ** 2
        # The subtraction may lose the small rest of a large square: a share of the square is given back.
        rest = np.maximum(rest, 0) + 1e-9 * self.norms**2
        return np.flatnonzero((known + query.rest_length * np.sqrt(rest)) * _MARGIN >= threshold)

    def scores(self, query: Query, docs: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores; ``dense`` is an array of zeros per term that is left as it was."""
        dense[query.numbers] = query.weights
        size = self.size[docs]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) - np.repeat(ends - size - self.starts[docs], size)
        found = np.add.reduceat(dense[self.numbers[at]] * self.impacts[at], ends - size)
        dense[query.numbers] = 0
        return found


class Query:
    """Term weights, heaviest first; the heaviest ones are looked at inside buckets."""

    def __init__(self, numbers: np.ndarray, weights: np.ndarray):
        order = np.argsort(-weights, kind="stable")
        self.numbers, self.weights = numbers[order], weights[order]
        squares = np.cumsum(self.weights.astype(np.float64) ** 2)
        self.length = math.sqrt(squares[-1]) * _MARGIN if len(squares) else 0.0
        focus = int(np.searchsorted(squares, _FOCUS * squares[-1])) + 1 if len(squares) else 0
        self.focus, self.focus_weights = self.numbers[:focus], self.weights[:focus].astype(np.float64)
        self.rest_length = math.sqrt(float((self.weights[focus:].astype(np.float64) ** 2).sum())) * _MARGIN


class Best:
    """The k highest scores above 0 so far, ties by key, nulls last."""

    def __init__(self, k: int, threshold: int):
        self.k, self.threshold = k, max(threshold, 1)
        self.scores = np.zeros(0, np.int64)
        self.places = np.zeros(0, np.int64)
        self.missing, self.ids = np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.threshold
        scores = np.append(self.scores, scores[good])
        missing = np.append(self.missing, missing[good])
        ids = np.append(self.ids, ids[good])
        kept = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.missing, self.ids = scores[kept], missing[kept], ids[kept]
        if len(kept) == self.k:
            self.threshold = max(self.threshold, int(scores[kept[-1]]))


def top_documents(
    vectors: DataFrame, items: list[np.ndarray], weights: np.ndarray, k: int = K, thresholds: list[int] | None = None
) -> DataFrame:
    """(item, key, score): per item (an array of term numbers) what can be among the k best; some more rows than that.

    ``thresholds`` are scores that the k-th best document of each item is known to reach.
    """
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [Query(numbers, weights[numbers]) for numbers in items]
        best = [Best(k, thresholds[i] if thresholds else 1) for i in range(len(items))]
        dense = np.zeros(len(weights), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                keys, norms, numbers, impacts = batch.slice(at, BUCKET).columns
                bucket = Bucket(
                    norms.to_numpy(), np.diff(numbers.offsets.to_numpy()), numbers.flatten().to_numpy(),
                    impacts.flatten().to_numpy(),
                )
                missing = keys.is_null().to_numpy(zero_copy_only=False)
                ids = keys.fill_null(0).to_numpy()
                for query, top in zip(queries, best):
                    docs = bucket.may_reach(query, top.threshold)
                    if len(docs):
                        top.add(bucket.scores(query, docs, dense), missing[docs], ids[docs])
        for i, top in enumerate(best):
            if len(top.scores):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(top.scores), i, np.int32)), pa.array(top.ids, mask=top.missing),
                    pa.array(top.scores),
                ], names=["item", "key", "score"])

    rows = vectors.select(F.col("key").cast("long").alias("key"), "norm", "terms", "impacts")
    return rows.mapInArrow(searched, "item int, key long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: list, key: str, text: str, k: int) -> DataFrame:
    """(item, rank, key, score) for a block of (number, terms) pairs."""
    words = sorted({w for _, found in block for w in found})
    vocabulary = {w: i for i, w in enumerate(words)}
    items = [np.array(sorted(vocabulary[w] for w in found), np.int64) for _, found in block]
    counts = cut(term_counts(docs, vocabulary, key, text))
    stats = statistics(counts, len(words))
    if not stats.total:
        return counts.select(*[F.lit(0).cast(t).alias(c) for c, t in
                               (("item", "int"), ("rank", "int"), ("key", "long"), ("score", "long"))]).limit(0)
    vectors = cut(impact_vectors(counts, stats))
    drop(counts)
    weights = stats.weights()
    # The longest vectors first: their k-th best scores are thresholds for all others.
    share = max(0.0, 1 - SEEDS / max(stats.documents, 1))
    length = vectors.agg(F.approx_percentile("norm", share, 10_000)).first()[0] or 0.0
    seeds = _ranked(top_documents(vectors.filter(F.col("norm") >= length), items, weights, k), k)
    reached = {r["item"]: r["score"] for r in seeds.filter(F.col("rank") == k).select("item", "score").collect()}
    thresholds = [reached.get(i, 1) for i in range(len(items))]
    return _ranked(top_documents(vectors, items, weights, k, thresholds), k)


def search(
    docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", k: int = K,
) -> DataFrame:
    """The k documents with the highest scores above 0 for each query: ``item``, rank, ``key``, score.

    Keys are whole numbers; ties go to the smaller key, null keys last; rows that repeat a key are ranked one by one. Null and
    empty texts hold no term: such documents are not counted and such queries find nothing. Each row of ``queries`` is
    ranked for itself, also if its id is null or repeats; a term that repeats in a query counts once. Empty tables give an empty result. Texts
    are taken whole; documents of one bucket are held in memory as term numbers, not as text. Other columns are not read.

    The driver gets the terms of one block of queries at a time (about ``BLOCK_QUERIES`` queries or ``BLOCK_BYTES`` of
    text, unless one query alone is longer) and one threshold per query.
    """
    numbered = cut(queries.select(
        F.col(item).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("number"),
    ))
    size = numbered.agg(F.count(F.lit(1)), F.sum(F.octet_length("text").cast("long"))).first()
    blocks = max(1, -(-size[0] // BLOCK_QUERIES), -(-(size[1] or 0) // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        own = numbered.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b) if blocks > 1 else numbered
        rows = own.select("number", F.col("text").cast("binary").alias("text")).collect()
        block = [(r["number"], set(terms(bytes(r["text"])))) for r in rows]
        names = own.sparkSession.createDataFrame([(i, n) for i, (n, _) in enumerate(block)], "item int, number long")
        found = _search_block(docs, block, key, text, k)
        found = cut(found) if blocks > 1 else found
        found = found.join(F.broadcast(names), "item").join(numbered.select("number", "item_id"), "number")
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("item_id").alias(item), "rank", F.col("key").alias(key), "score")
