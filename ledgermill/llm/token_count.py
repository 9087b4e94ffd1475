"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as one symbol per byte. A heap yields its adjacent pair of lowest rank, the leftmost first;
the two symbols become one in a doubly linked list and the new neighbours enter the heap. The count is
the initial symbols minus the merges; no list of ids is made. Words repeat, so a task remembers
the counts of short ones.

Special tokens of the vocabulary count as one where their strings stand in a text, as the library does by default.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents with more tokens are marked.
LIMIT = 2048
#: Words a task remembers before it starts anew, and the longest of them in symbols; this bounds its memory.
REMEMBERED, LONGEST = 400_000, 64
# Texts taken out of an Arrow batch at a time.
_TEXTS = 256

# Below this, letters, numbers and blanks are told apart here; texts with other characters, or with one of the
# few whose lower case is not one character below it, are split by the library.
_LATIN = 0x250
_BLANKS = {*range(9, 14), 0x20, 0x85, 0xA0}


def _latin_class(kind: str | None) -> str:
    def of(c: int) -> str | None:
        return "blank" if c in _BLANKS else unicodedata.category(chr(c))[0]

    chars = (c for c in range(_LATIN) if of(c) == kind or kind is None and of(c) not in ("blank", "L", "N"))
    return "".join(f"\\u{c:04x}" for c in chars)


_PLAIN = "".join(f"\\u{c:04x}" for c in range(_LATIN) if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < _LATIN)
_IS_PLAIN = re.compile(f"[{_PLAIN}]*").fullmatch
# The words of the vocabulary's own pattern, for lower-cased plain text.
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_latin_class('L')}]+|[{_latin_class('N')}]|[{_latin_class(None)}]+"
).findall
_CHUNKS = re.compile(r"[^\x09-\x0d\x20]+").findall
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Merges:
    """Ranks of the pairs of a byte-level vocabulary, and counts of what merging leaves."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.ids = {c: k for c, k in vocab.items() if len(c) == 1}
        self.last = {c: vocab[c + suffix] for c in self.ids if c + suffix in vocab}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]

    def count(self, word: str) -> int:
        """Symbols left of ``word`` (its bytes as the vocabulary writes them) when no pair can merge any more."""
        known = [self.ids[c] for c in word[:-1] if c in self.ids]
        if word[-1:] in self.last:
            known.append(self.last[word[-1]])
        left = n = len(known)
        ranks, made = self.ranks, self.made
        ids, after, before = known, list(range(1, n + 1)), list(range(-1, n - 1))
        if n > LONGEST:  # slower, but a fifth of the memory
            ids, after, before = array("q", ids), array("q", after), array("q", before)
        # Rank and place in one number: the lowest rank is popped first, the leftmost of equal ones.
        heap = [
            rank << 40 | i for i in range(n - 1) if (rank := ranks.get((known[i], known[i + 1]))) is not None
        ]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            rank, i = entry >> 40, entry & 0xFF_FFFF_FFFF
            j = after[i]
            if j >= n or ids[i] < 0 or ranks.get((ids[i], ids[j])) != rank:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = made[rank], -1
            left -= 1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (rank := ranks.get((ids[i], ids[k]))) is not None:
                    heappush(heap, rank << 40 | i)
            if h >= 0 and (rank := ranks.get((ids[h], ids[i]))) is not None:
                heappush(heap, rank << 40 | h)
        return left


class _Counts(dict):
    """Counts of words, each found once and remembered if short."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, word: str) -> int:
        found = self.count(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Counter:
    """Counts the tokens of texts as the ``tokenizers`` library does for the vocabulary at ``path``."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        # The library lends its normaliser and its word splitter, for texts beyond Latin and other vocabularies.
        self.library = Tokenizer.from_file(path)
        made_of = json.loads(self.library.to_str())
        if made_of["model"]["type"] != "BPE":
            raise ValueError(f"{path} is no byte-pair vocabulary")
        odd = [t for t in made_of["added_tokens"] if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        if odd:
            raise ValueError(f"added tokens that take neighbouring text along are not supported: {odd}")
        contents = sorted((t["content"] for t in made_of["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, contents)) or "(?!)")
        self.merges = Merges(made_of["model"])
        visible = self._visible()
        self.bytes = str.maketrans({chr(b): visible[b] for b in range(256)})
        kinds = [n["type"] for n in (made_of.get("normalizer") or {}).get("normalizers", [])]
        splits = (made_of.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.known = kinds == ["NFC", "Replace", "Lowercase"] and (
            splits[0].get("pattern", {}).get("Regex") == _PATTERN
        )
        self.plain = _Counts(self._plain_word)
        self.chunks = _Counts(self._library_text)

    @staticmethod
    def _visible() -> list[str]:
        """Bytes as byte-level vocabularies write them: visible Latin characters stay, others follow from 256 on."""
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = iter(range(256, 512))
        return [chr(b if b in shown else next(others)) for b in range(256)]

    def _plain_word(self, word: str) -> int:
        return self.merges.count(word.encode().decode("latin-1").translate(self.bytes))

    def _library_text(self, text: str) -> int:
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        pieces = self.library.pre_tokenizer.pre_tokenize_str(normal) if self.library.pre_tokenizer else [(normal, None)]
        return sum(self.merges.count(piece) for piece, _ in pieces)

    def _count_part(self, part: str) -> int:
        if not self.known:
            return self._library_text(part)
        if part.isascii() or _IS_PLAIN(part):
            return sum(map(self.plain.__getitem__, _WORDS(part.lower())))
        # Nothing reaches over a blank, so only the chunks with other characters go to the library.
        return sum(
            self._count_part(chunk) if _IS_PLAIN(chunk) else self.chunks[chunk] for chunk in _CHUNKS(part)
        )

    def count(self, text: str) -> int:
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._count_part, parts))


def count_tokens(
    docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, vocabulary: str | None = None
) -> DataFrame:
    """Bytes and tokens per document: ``key``, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is the path of a byte-level byte-pair vocabulary in the ``tokenizers`` format, on every executor;
    without one it is the public ``word_bpe_49k.json``. No begin, end or other token is added.

    One row per row of ``docs``, whatever repeats; other columns are not read. A null text counts as empty: 0 bytes, 0 tokens. A null
    key stays null. An empty table gives an empty one. Texts of any length are counted whole; a word without any
    blank, letter or number boundary costs some 100 bytes of memory per byte while it is merged.
    No shuffle: each task counts its own rows.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            ids, texts = batch.columns
            for at in range(0, batch.num_rows, _TEXTS):
                tokens = [counter.count(t) for t in texts.slice(at, _TEXTS).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, _TEXTS), pa.array(tokens, pa.int64())], names=["key", "n_tokens"]
                )

    # The id travels with the number of bytes, which the JVM knows, through Python.
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct(F.col(key).alias("id"), F.octet_length(whole).cast("long").alias("n_bytes")).alias("key"),
        whole.alias("text"),
    )
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(counted, f"key {key_type}, n_tokens long").select(
        F.col("key.id").alias(key), F.col("key.n_bytes").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
