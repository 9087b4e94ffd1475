"""Vector codes: every part of a vector becomes the number of its nearest codebook entry, found in a GNAT.

A geometric near-neighbour access tree over the entries of a codebook: a node holds split points, and for every
split point the range of its distances to the entries below each other split point. One distance from a
query to a split point then rules out whole subtrees. Subtrees go only if they are strictly farther than the
best entry so far, with roots rounded against the elimination; what is left is compared by squared distances in
integers, ties going to the lower number. So the result is that of comparing with every entry.

Codebooks are trained by rounds of assignment and averaging. A round is one pass over the vectors; a task
returns sums per entry, and the driver gets one number per codebook component.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.frames import cut
from ledgermill.operators.joins import keyed_join

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components from this size on count as non-finite: the square of one alone would not fit a long.
TOO_LARGE = 2.0**50
# Integers up to this size are handled as 64-bit numbers, larger ones as Python's.
_SMALL = 1 << 24
_ROWS = 4096
# Sums travel in two halves.
_HALF = 40


# --- the tree -------------------------------------------------------------------------

_int_root = np.frompyfunc(math.isqrt, 1, 1)


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers not above and not below the roots of ``squares``."""
    if squares.dtype == object:
        low = _int_root(squares)
        return low, low + 1
    low = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    return np.maximum(low - 1, 0), low + 2


def _squares(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return ((points - point) ** 2).sum(axis=1) if points.shape[1] else np.zeros(len(points), points.dtype)


class Gnat:
    """Nearest of a few integer points by squared distance, ties to the lower number."""

    def __init__(self, points: np.ndarray, numbers: np.ndarray | None = None, degree: int = 4):
        numbers = np.arange(len(points)) if numbers is None else numbers
        self.numbers = self._spread_out(points, numbers, degree)
        self.splits = points[self.numbers]
        rest = np.array([k for k in numbers if k not in set(self.numbers.tolist())], np.int64)
        to_split = np.array([_squares(points[rest], s) for s in self.splits]).reshape(len(self.splits), len(rest))
        nearest = to_split.argmin(axis=0) if len(rest) else rest
        below = [rest[nearest == j] for j in range(len(self.splits))]
        self.below = [Gnat(points, b, degree) if len(b) else None for b in below]
        # Distances from split i to split j and what is below it; for j = i without the split itself.
        self.ranges: dict[tuple[int, int], tuple[int, int]] = {}
        for i, split in enumerate(self.splits):
            for j, members in enumerate(below):
                group = members if i == j else np.append(members, self.numbers[j])
                if len(group):
                    low, high = _roots(_squares(points[group], split))
                    self.ranges[i, j] = (low.min(), high.max())

    @staticmethod
    def _spread_out(points: np.ndarray, numbers: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` of the points, each as far as can be from those before it."""
        if len(numbers) <= degree:
            return numbers
        chosen = [numbers[0]]
        far = _squares(points[numbers], points[numbers[0]])
        while len(chosen) < degree:
            far[np.isin(numbers, chosen)] = -1
            chosen.append(numbers[int(far.argmax())])
            far = np.minimum(far, _squares(points[numbers], points[chosen[-1]]))
        return np.array(chosen)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) per query."""
        best = np.full(len(queries), -1, queries.dtype)
        found = np.full(len(queries), -1, np.int64)
        self._search(queries, np.arange(len(queries)), found, best)
        return found, best

    def _search(self, queries: np.ndarray, rows: np.ndarray, found: np.ndarray, best: np.ndarray) -> None:
        """Improves ``found`` and ``best`` of ``rows``, whose subtree this is and was not ruled out."""
        alive = np.ones((len(self.splits), len(rows)), bool)  # the subtree
        for i, (split, number) in enumerate(zip(self.splits, self.numbers)):
            at = np.flatnonzero(alive[i])
            if not len(at):
                continue
            asked = rows[at]
            square = _squares(queries[asked], split)
            first = found[asked] < 0
            better = first | (square < best[asked]) | ((square == best[asked]) & (number < found[asked]))
            best[asked[better]], found[asked[better]] = square[better], number
            low, high = _roots(square)
            _, radius = _roots(best[asked])
            for j in range(len(self.splits)):
                # Split j and its subtree, if still to come; of split i only its subtree.
                if (i, j) in self.ranges and (j > i or self.below[j] is not None):
                    nearest_below, farthest_below = self.ranges[i, j]
                    out = (low - farthest_below > radius) | (nearest_below - high > radius)
                    alive[j, at[out]] = False
        for j, tree in enumerate(self.below):
            if tree is not None and alive[j].any():
                tree._search(queries, rows[alive[j]], found, best)


# --- codebooks ------------------------------------------------------------------------

def integers(rows: np.ndarray) -> np.ndarray:
    """floor(4096 x) of finite numbers; Python integers where 64-bit arithmetic on them could overflow."""
    scaled = np.floor(rows * float(SCALE))
    if not rows.size or np.abs(scaled).max() <= _SMALL:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


@dataclass(frozen=True)
class Codebooks:
    """Entries per part: ``books[part][entry]`` is a tuple of integers."""

    width: int
    books: tuple[tuple[tuple[int, ...], ...], ...]

    def trees(self) -> list[Gnat]:
        out = []
        for book in self.books:
            entries = np.array(book, object).reshape(len(book), self.width // len(self.books))
            small = not entries.size or max(map(abs, entries.ravel())) <= _SMALL
            out.append(Gnat(entries.astype(np.int64) if small else entries))
        return out

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for e in b for x in e).encode()).hexdigest()


def assign(vectors: np.ndarray, trees: list[Gnat]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, that part of all vectors, entry numbers, squared distances) for each part."""
    size = vectors.shape[1] // len(trees)
    for part, tree in enumerate(trees):
        piece = vectors[:, part * size : (part + 1) * size]
        if tree.splits.dtype == object:
            piece = piece.astype(object)
        yield part, piece, *tree.nearest(piece)


def _matrices(batch_column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(0, len(batch_column), _ROWS):
        piece = batch_column.slice(at, _ROWS)
        yield at, integers(piece.flatten().to_numpy(zero_copy_only=False).reshape(len(piece), width))


def _usable(vector: str) -> Column:
    each = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(TOO_LARGE)))
    return F.coalesce(each, F.lit(False))


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.filter(_usable(vector)).withColumn(vector, F.col(vector).cast("array<double>"))


def train(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``vectors``; None if no vector can be used.

    They start as the parts of the ``entries`` vectors with the smallest keys (null keys last, equal keys by their
    vectors; fewer if there are fewer). The driver holds codebooks only: ``entries`` times the width numbers.
    """
    kept = _kept(vectors.select(key, vector), vector)
    widths = kept.groupBy(F.size(vector).alias("width")).count().filter(F.col("width") % parts == 0)
    common = widths.orderBy(F.desc("count"), F.desc("width")).first()
    if common is None:
        return None
    width = common["width"]
    size = width // parts
    fitting = kept.filter(F.size(vector) == width)
    first = fitting.orderBy(F.col(key).asc_nulls_last(), vector).limit(entries).collect()
    start = [[math.floor(x * SCALE) for x in row[vector]] for row in first]
    books = tuple(tuple(tuple(v[p * size : (p + 1) * size]) for v in start) for p in range(parts))
    for _ in range(rounds if width else 0):
        now = Codebooks(width, books)

        def sums(batches: Iterator[pa.RecordBatch], now: Codebooks = now) -> Iterator[pa.RecordBatch]:
            trees = now.trees()
            count = np.zeros((parts, len(now.books[0])), np.int64)
            total = np.zeros((*count.shape, size), object)
            for batch in batches:
                for _, matrix in _matrices(batch.column(0), width):
                    for part, piece, entry, _ in assign(matrix, trees):
                        for e in np.unique(entry):
                            own = piece[entry == e]
                            count[part, e] += len(own)
                            total[part, e] += own.sum(axis=0).astype(object)
            flat = total.ravel().tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(flat)), pa.int64()), pa.array([x >> _HALF for x in flat], pa.int64()),
                pa.array([x & (1 << _HALF) - 1 for x in flat], pa.int64()), pa.array(np.repeat(count.ravel(), size)),
            ], names=["slot", "high", "low", "n"])

        exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
        rows = fitting.select(vector).mapInArrow(sums, "slot long, high long, low long, n long")
        found = {r["slot"]: r for r in rows.groupBy("slot").agg(*exact).collect()}
        flat = [x for book in books for entry in book for x in entry]
        moved = [
            ((int(found[k]["high"]) << _HALF) + int(found[k]["low"])) // int(found[k]["n"])
            if k in found and found[k]["n"] else x
            for k, x in enumerate(flat)
        ]
        n = len(books[0])
        after = tuple(
            tuple(tuple(moved[(p * n + e) * size : (p * n + e + 1) * size]) for e in range(n)) for p in range(parts)
        )
        if after == books:
            break  # further rounds would change nothing
        books = after
    return Codebooks(width, books)


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """All columns of ``vectors`` but the vector, with ``code`` and ``error`` (own columns of these names are replaced), for
    vectors that can be used.

    ``code`` has two hexadecimal digits per part. Both are null where a vector has another width than the codebooks,
    ``error`` also where it does not fit a long.
    """
    others = F.struct(*[F.col(c) for c in vectors.columns if c not in (vector, "code", "error")]).alias("row")
    rows = _kept(vectors, vector).select(others, F.col(vector).alias("vector"))
    most = (1 << 63) - 1

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        for batch in batches:
            for at, matrix in _matrices(batch.column(1), books.width):
                entries = np.zeros((len(matrix), len(trees)), np.uint8)
                error = np.zeros(len(matrix), np.int64)
                for part, _, entry, square in assign(matrix, trees):
                    entries[:, part], error = entry, error + square
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(matrix)), pa.array([bytes(row).hex() for row in entries], pa.string()),
                    pa.array([int(x) if x <= most else None for x in error], pa.int64()),
                ], names=["row", "code", "error"])

    row_type = rows.schema["row"].dataType.simpleString()
    fits = F.size("vector") == books.width
    out = rows.filter(fits).mapInArrow(coded, f"row {row_type}, code string, error long")
    return out.unionByName(rows.filter(~fits).select(
        "row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )).select("row.*", "code", "error")


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors: ``key``, code, error, label_error, codebooks_sha256.

    Vectors that are null, or hold null, non-finite or absurdly large (``TOO_LARGE``) components, are left out. Components become
    floor(4096 x). The width is the most frequent one that divides into parts (the larger of equally frequent ones);
    vectors of other widths stay, with null code and error. Keys may be null or repeat; every row is coded. Labels may be
    null, which counts as one label; ``label_error`` is null if no error of the label is known or it does not fit a long. Without a
    usable vector the result is empty, with null digests. Other columns are not read.
    """
    books = train(vectors, key, vector, parts, entries, rounds)
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    if books is None:
        empty = rows.filter(_usable("vector"))
        return empty.select(
            F.col("key").alias(key), *[F.lit(None).cast("string" if c in ("code", "codebooks_sha256") else "long").alias(c)
                                       for c in ("code", "error", "label_error", "codebooks_sha256")]
        )
    coded = cut(encode(rows, books, "vector"))
    # One row per label, summed before the shuffle; rows of a hot label are salted for the join.
    total = F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)").alias("label_error")
    labels = coded.groupBy("label").agg(total)
    joined = keyed_join(
        coded, labels, ["label"], how="left", null_safe=True, force_salt=True, spread=["key"], profile=coded.select("label")
    )
    return joined.select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
