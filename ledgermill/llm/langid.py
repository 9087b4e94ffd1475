"""Language identification with string kernels.

A text is the set of byte n-grams (n = 1, 2, 3) that occur in it, letters only and A-Z lower-cased. The
kernel of two texts is the sum over n of the shared n-grams, each normalised by the sizes of both sets.
Nystroem landmarks turn it into features, kernel ridge regression fits one score per
language against the rest, and both steps fold into one matrix per n: a batch of texts is scored by
multiplying its presence matrices with them. Texts are scored in pieces whose scores are
averaged by length, so that a foreign passage counts by its share of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm import kernels as K
from ledgermill.llm.frames import held_out, small_batches

#: Pieces per language that are learned from, and those of them that are landmarks. They are picked from all pieces of
#: about SOURCES texts per language, whole texts whatever their length.
LEARNED, LANDMARKS, SOURCES = 200, 40, 400
#: Bytes of a piece, of learned texts and of texts that are identified.
PIECE = 1024
ORDERS = (1, 2, 3)
RIDGE = 1e-2
UNKNOWN = "und"

# A-Z as a-z, bytes of other letters as they are, everything else as a space.
_SYMBOL = np.full(256, 32, np.uint32)
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[128:] = np.arange(128, 256)


_BLOCK = 1 << 20


def grams(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code and text number of every n-gram that lies within one text, a block at a time."""
    for at in range(0, len(data), _BLOCK):
        symbols = _SYMBOL[data[at : at + _BLOCK + n - 1]]
        end = at + len(symbols)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.clip(offsets, at, end)))
        size = len(symbols) - n + 1
        if size <= 0:
            return
        codes = np.zeros(size, np.uint32)
        for k in range(n):
            codes = codes << np.uint32(8) | symbols[k : k + size]
        inside = owner[:size] == owner[n - 1 :]
        yield codes[inside], owner[:size][inside]


@dataclass
class Model:
    """Languages, the n-gram codes in use per order, their weights, and the sharpness of the score."""

    languages: list[str]
    codes: list[np.ndarray]
    weights: list[np.ndarray]
    sharpness: float

    def presence(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        return [
            _presence(data, offsets, n, table, len(codes))
            for n, table, codes in zip(ORDERS, self.tables(), self.codes)
        ]

    def tables(self) -> list[np.ndarray]:
        """Column of every possible code, -1 for those not in use; made once per process."""
        if not hasattr(self, "_tables"):
            self._tables = []
            for n, codes in zip(ORDERS, self.codes):
                table = np.full(1 << 8 * n, -1, np.int32)
                table[codes] = np.arange(len(codes))
                self._tables.append(table)
        return self._tables

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean score of each text's pieces, weighted by their bytes."""
        sizes = np.diff(offsets)
        count = np.maximum(1, -(-sizes // PIECE))
        first = np.concatenate(([0], np.cumsum(count)))
        within = np.arange(first[-1]) - np.repeat(first[:-1], count)
        starts = np.repeat(offsets[:-1], count) + within * PIECE
        edges = np.append(starts, offsets[-1])
        weight = np.diff(edges).astype(float)
        total = np.zeros((len(starts), len(self.languages)))
        for a in range(0, len(starts), 512):
            part = edges[a : a + 513]
            x = self.presence(data[part[0] : part[-1]], part - part[0])
            total[a : a + 512] = sum(p @ w for p, w in zip(x, self.weights))
        summed = np.add.reduceat(total * weight[:, None], first[:-1], axis=0)
        return summed / np.maximum(sizes, 1)[:, None]


def _presence(data, offsets, n, table, width) -> np.ndarray:
    """Texts by n-grams, 1 where the n-gram occurs, rows scaled to length 1."""
    out = np.zeros((len(offsets) - 1) * width, np.float32)
    for codes, owner in grams(data, offsets, n):
        column = table[codes]
        known = column >= 0
        out[owner[known] * width + column[known]] = 1
    out = out.reshape(len(offsets) - 1, width)
    size = np.sqrt(out.sum(axis=1, keepdims=True))
    return out / np.maximum(size, 1)


def _packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def fit(texts: list[bytes], languages: list[str]) -> Model:
    """Model from labelled texts; those listed first in each language become landmarks."""
    names = sorted(set(languages))
    if not names:
        return Model([], [], [], 1.0)
    label = np.array([names.index(x) for x in languages])
    marks = np.concatenate([np.flatnonzero(label == k)[:LANDMARKS] for k in range(len(names))])
    data, offsets = _packed([texts[k] for k in marks])
    codes = [
        np.unique(np.concatenate([c for c, _ in grams(data, offsets, n)] or [np.zeros(0, np.uint32)]))
        for n in ORDERS
    ]
    model = Model(names, codes, [], 1.0)
    landmarks = model.presence(data, offsets)
    every = model.presence(*_packed(texts))
    among = sum(z @ z.T for z in landmarks).astype(float)
    across = sum(x @ z.T for x, z in zip(every, landmarks)).astype(float)
    values, vectors = np.linalg.eigh(among)
    kept = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = across @ root
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = 1 / np.bincount(label, minlength=len(names))[label]  # every language weighs the same
    weighted = features * share[:, None]
    ridge = RIDGE * len(names) * np.eye(features.shape[1]) / max(1, features.shape[1])
    solved = np.linalg.solve(weighted.T @ features + ridge, weighted.T @ target)
    onto = root @ solved
    weights = [(z.T @ onto).astype(np.float32) for z in landmarks]
    # Sharpness of the reported score: the one under which the learned labels are likeliest.
    raw = features @ solved

    def loss(s: float) -> float:
        e = s * (raw - raw.max(axis=1, keepdims=True))
        return -float((share * (e[np.arange(len(label)), label] - np.log(np.exp(e).sum(axis=1)))).sum())

    return Model(names, codes, weights, min((0.5, 1, 2, 3, 4, 6, 8, 12, 16), key=loss))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.chunks(batch, "text"):
                data, offsets = K.text_buffers(part.column("text"))
                letters = np.zeros(len(data) + 1, np.int64)
                np.cumsum((_SYMBOL[data] >= 97) & (data < 128), out=letters[1:])
                has = letters[offsets[1:]] > letters[offsets[:-1]]
                for k in np.flatnonzero(~has):
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    has[k] = any(c.isalpha() for c in raw.decode("utf-8", "replace"))
                if model.languages:
                    raw = model.scores(data, offsets).astype(float)
                    best = raw.argmax(axis=1)
                    spread = np.exp(model.sharpness * (raw - raw.max(axis=1, keepdims=True)))
                    score = np.where(has, 1 / spread.sum(axis=1), 0.0)
                    names = [model.languages[b] if h else UNKNOWN for b, h in zip(best, has)]
                else:
                    score, names = np.zeros(len(part)), [UNKNOWN] * len(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def learn(docs: DataFrame) -> Model:
    """Model from documents with a language that are not held out.

    A fixed hash of the id picks about SOURCES rows per language, one of the id and the place LEARNED of their pieces;
    the counts behind it cover the table.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).filter("lang is not null and text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return fit([], [])
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, 1.0 * SOURCES / n)])
    ticket = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) / float(1 << 30)
    texts = known.filter(ticket < share[F.col("lang")])
    place = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))))
    pieces = texts.withColumn("place", place).select(
        "lang", F.xxhash64("doc_id", "place", F.lit(6)).alias("order"),
        F.substring("text", F.col("place") * PIECE + 1, F.lit(PIECE)).alias("piece"),
    )
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order", "piece"))
    rows = pieces.withColumn("nth", nth).filter(F.col("nth") <= LEARNED).select("lang", "nth", "piece").collect()
    rows.sort(key=lambda r: (r["lang"], r["nth"]))
    return fit([r["piece"].encode() for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    A null text and one without a letter are ``und`` with score 0, as is every text when no language could be
    learned. A text none of whose n-grams is known gets the first language with score 1 / languages. Rows
    with a null lang are not learned but identified. A text of any length is scored by all its pieces. Repeated rows are returned as often as they occur, a null
    doc_id is kept, and other columns are not read.
    """
    model = learn(docs)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return small_batches(rows).mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
