"""Compression classifier of text quality.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts. A text is cut into blocks of a few
kilobytes and every block is compressed afresh with either dictionary, as a dictionary helps only near the start of a frame.
The difference of the sizes over the text's length, put through a logistic curve fitted on other
labelled texts, is its score.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import kernels as K
from ledgermill.llm.frames import held_out, small_batches

#: Labelled texts per class from which the dictionaries are trained, and on which the curve is fitted.
TRAINED, FITTED = 3000, 3000
#: Blocks per class that a dictionary is trained on, chosen by their checksum from all blocks of the trained texts.
SAMPLED = 6000
#: Bytes of a block at most.
BLOCK = 4096
DICTIONARY_BYTES = 65_536
LEVEL = 3
_COLUMNS = "doc_id long, held_out boolean, score double, predicted int"
_TEXTS = 256


def blocks(text: bytes) -> list[bytes]:
    """The text in as few parts as its length calls for, of nearly equal length; none for an empty text."""
    n = -(-len(text) // BLOCK)
    return [text[len(text) * k // n : len(text) * (k + 1) // n] for k in range(n)]


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; where texts are too few to train one, their content itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[:DICTIONARY_BYTES]


def _compressors(dictionaries: tuple[bytes, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in dictionaries:
        kind = zstandard.ZstdCompressionDict(content) if content else None
        if kind is not None:
            kind.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=kind, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return out


def differences(texts: list[bytes], dictionaries: tuple[bytes, bytes]) -> np.ndarray:
    """Bytes per byte of text that the bad dictionary saves over the good one; 0 for an empty text."""
    good, bad = _compressors(dictionaries)
    return np.array(
        [sum(len(good.compress(b)) - len(bad.compress(b)) for b in blocks(t)) / len(t) if t else 0.0 for t in texts], float
    )


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic curve, by Newton's method with a slight penalty."""
    scale = float(np.std(x)) or 1.0
    rows = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (weight * (y - p)) - 1e-3 * beta
        hessian = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def _train_dictionaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class from (quality, text) rows; holds SAMPLED blocks per class, whatever the texts' length."""
    kept: dict[int, list] = {0: [], 1: []}
    for batch in batches:
        for quality, text in zip(*(c.to_pylist() for c in batch.columns)):
            heap = kept[quality]
            for block in blocks(text):
                entry = (-zlib.crc32(block), block)
                if len(heap) < SAMPLED:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    # In one order, so that the same blocks always make the same dictionary.
    made = [_dictionary([b for _, b in sorted(kept[q], reverse=True)]) if kept[q] else b"" for q in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(made, pa.binary())], names=["quality", "made"])


def _differ(dictionaries: tuple[bytes, bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = differences(batch.column(1).to_pylist(), dictionaries)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x)], names=["quality", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> tuple[tuple[bytes, bytes], float, float]:
    """(dictionaries, slope, intercept) from labelled rows that are not held out.

    A fixed hash of the id picks at most TRAINED and FITTED rows per class; the curve weighs the classes by
    their numbers among all labelled rows, counted over the whole table. Texts are read whole. One executor task trains the
    dictionaries; the driver gets ids, the dictionaries and one number per fitted text.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).filter(~held_out(F.col("doc_id")))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    most = TRAINED + FITTED
    # About one and a half times what is kept, so the driver never sees more than a bounded sample.
    share = {q: min(1.0, 1.5 * most / n) for q, n in counts.items()}
    order = F.xxhash64("doc_id", F.lit(5))
    ticket = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    limit = F.when(F.col("quality") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    rows = sorted(tuple(r) for r in usable.filter(ticket < limit).select(order.alias("order"), "doc_id", "quality").collect())
    ids: dict[int, list[int]] = {0: [], 1: []}
    seen = set()
    for _, doc_id, q in rows:
        if doc_id not in seen:
            seen.add(doc_id)
            ids[q].append(doc_id)
    parts = []
    for q, own in ids.items():
        own = own[:most]
        split = min(TRAINED, -(-len(own) * 6 // 10))
        parts += [(i, q, True, False) for i in own[:split]]
        # With one text of a class, it serves for both.
        parts += [(i, q, not own[split:], True) for i in own[split:] or own[:split]]
    if not parts:
        return (b"", b""), 0.0, 0.0
    chosen = docs.sparkSession.createDataFrame(parts, "doc_id long, quality int, trains boolean, fits boolean").distinct()
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
        .filter(F.length("text") > 0)
        .join(F.broadcast(chosen), "doc_id")  # at most 2 * (TRAINED + FITTED) ids
    )
    dictionaries = {
        r["quality"]: bytes(r["made"])
        for r in small_batches(texts).filter("trains").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
        .select("quality", "text").repartition(1).mapInArrow(K.tidy(_train_dictionaries), "quality int, made binary").collect()
    }
    pair = dictionaries.get(1, b""), dictionaries.get(0, b"")
    fitted = (
        texts.filter("fits").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("quality", "text")
        .mapInArrow(K.tidy(_differ(pair)), "quality int, x double").collect()
    )
    x = {q: sorted(r["x"] for r in fitted if r["quality"] == q) for q in (1, 0)}
    if not x[1] or not x[0]:
        # One class only: nothing to tell apart, every text gets that class's score.
        return pair, 0.0, 30.0 if x[1] else -30.0 if x[0] else 0.0
    y = np.concatenate([np.full(len(x[q]), float(q)) for q in (1, 0)])
    weight = np.concatenate([np.full(len(x[q]), counts[q] / len(x[q])) for q in (1, 0)])
    return pair, *_fit(np.array(x[1] + x[0]), y, weight)


def _values(texts: pa.Array, model) -> np.ndarray:
    dictionaries, slope, intercept = model
    texts = texts.cast(pa.binary())
    out = [np.zeros(0)]
    for at in range(0, len(texts), _TEXTS):
        out.append(differences([t or b"" for t in texts.slice(at, _TEXTS).to_pylist()], dictionaries))
    return 1 / (1 + np.exp(-np.clip(slope * np.concatenate(out) + intercept, -30, 30)))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score 0.5 or more, with all their columns; see :func:`score`."""
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_values(batch.column("text"), model) >= 0.5))

    return small_batches(docs).mapInArrow(K.tidy(run), docs.schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    A null text counts as empty; an empty text gets the score of a difference of 0. A text of any length is scored by all
    its blocks. Labels other than 0 and 1
    and null ids are not learned; of rows that repeat an id the least text is. Without labels every score is 0.5. Repeated rows
    are scored as often as they occur, and a null doc_id is kept. Other columns of either table are not read.
    """
    model = train(docs, labels)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = _values(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array(value), pa.array((value >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return small_batches(rows).mapInArrow(K.tidy(run), _COLUMNS)
