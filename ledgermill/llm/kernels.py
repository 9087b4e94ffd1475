"""Vectorised helpers that run inside Arrow batches.

Texts stay in Arrow's buffers; words are found and hashed for a whole batch at a time, in blocks
that bound memory however long one text is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at a time; a single longer text is handled alone.
CHUNK = 1 << 20
_BLOCK = 1 << 18

_GOLD = 0x9E3779B97F4A7C15
_M1, _M2, _S = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


def give_back() -> None:
    """Hand freed memory back to the system; allocators keep it otherwise, and Spark's workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only in glibc
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; the worker gives back its memory at the end of each task, so that idle ones hold little."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of MurmurHash3)."""
    x = x ^ (x >> _S)
    x *= _M1
    x ^= x >> _S
    x *= _M2
    x ^= x >> _S
    return x


def salt(n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out, filled = np.ones(n, np.uint64), 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


_BASE = _GOLD | 1
_POWER = [_powers(_BASE, _BLOCK)]
_INVERSE = [_powers(pow(_BASE, -1, 1 << 64), _BLOCK)]

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_CODES = salt(256)
_LOWER = _CODES.copy()
_LOWER[65:91] = _LOWER[97:123]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each, one row at least."""
    _, offsets = text_buffers(batch.column(column))
    at = 0
    while at < len(batch):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = max(at + 1, min(end, len(batch)))
        yield batch.slice(at, end - at)
        at = end


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, index, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def run_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray
) -> np.ndarray:
    """64-bit hash of every byte range, in blocks.

    A range is hashed as a polynomial over its byte codes, read off a running sum. Ranges are in
    order and do not overlap.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        first = int(starts[at])
        until = max(at + 1, int(np.searchsorted(ends, first + _BLOCK, side="right")))
        last = int(ends[until - 1])
        size = last - first
        if size > len(_POWER[0]):
            grown = 1 << size.bit_length()
            _POWER[0] = _powers(_BASE, grown)
            _INVERSE[0] = _powers(pow(_BASE, -1, 1 << 64), grown)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(codes[data[first:last]] * _POWER[0][:size], out=total[1:])
        a, b = starts[at:until] - first, ends[at:until] - first
        out[at:until] = (total[b] - total[a]) * _INVERSE[0][np.minimum(a, size - 1)]
        at = until
    return mix(out + (ends - starts).astype(np.uint64) * _M2)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes other than space and 9 to 13."""
    inside = ~_SPACE[data]
    begin, final = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    final[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begin[edge] = inside[edge]
    final[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(final) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, with A-Z lower-cased."""
    data, offsets = text_buffers(texts)
    starts, ends, owner = words(data, offsets)
    return run_hashes(data, starts, ends, _LOWER), owner


_STEP = salt(64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(size))
    for k in range(size):
        total += hashes[k : k + n] * _STEP[k]
    return mix(total)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles of each text as signed 64-bit values.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    hashes, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    first = np.concatenate(([0], np.cumsum(counts)))
    whole = windows(hashes, size).view(np.int64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        n = b - a
        if n >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        else:
            out.append(windows(hashes[a:b], n).view(np.int64) if n else np.zeros(0, np.int64))
    return out


def ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column of the given arrays."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


# A bitmap of fixed size that says which hashes may occur in a set. It only spares work: what
# passes is joined exactly afterwards, and a full bitmap lets everything pass.
FILTER_BITS = 1 << 23


def filter_slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(8)) % np.uint64(FILTER_BITS)


def may_contain(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = filter_slots(hashes)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0
