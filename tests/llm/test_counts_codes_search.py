"""Token counts, vector codes and lexical search against the library and plain Python, with edge cases."""

import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgermill.llm import lexical, token_count, vector_codes

SF = "/root/testdata/sf0.001"


# --- token counts -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokens_of_every_latin_character_and_of_mixed_texts(library):
    counter, rng = token_count.Counter(), random.Random(5)
    letters = [chr(c) for c in range(0x250)] + list("stremvld 'abc \n1") * 20 + [
        "<|endoftext|>", "<|startoftext|>", "<|", "|>", "́", "Σ", "漢", "\U0001f600", "K", " ", " ",
    ]
    texts = [f"ab{chr(c)}cd'{chr(c)}s 1{chr(c)}!{chr(c)}" for c in range(0x250)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(3000)]
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == expected


def test_tokens_of_very_long_words(library):
    counter = token_count.Counter()
    for text in ("a" * 30_000, "the" * 9_000, "-=" * 5_000, "漢字" * 2_000, "x1" * 9_000):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_words_are_forgotten_without_changing_counts(library, monkeypatch):
    monkeypatch.setattr(token_count, "REMEMBERED", 3)
    counter, text = token_count.Counter(), "one two three four five one two three four five"
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counter.plain) <= 3


def test_another_vocabulary_is_split_by_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, counter = Tokenizer.from_file(path), token_count.Counter(path)
    for text in ("Hello  world, it's 12345!\n\n x", "  漢 été", "a<|endoftext|>b", ""):
        assert counter.count(text) == len(plain.encode(text, add_special_tokens=False).ids)


def test_count_tokens_rows(spark, library):
    rows = [(1, "Hello <|endoftext|> world", 7), (2, None, 7), (3, "", 7), (1, "Hello <|endoftext|> world", 8),
            (None, "été", 9), (5, "word " * 2048, 0), (6, "word " * 2049, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    found = sorted(token_count.count_tokens(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    expected = sorted(
        ((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows),
        key=lambda r: (r[0] is None, r[0] or 0),
    )
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in found] == expected
    assert {r.doc_id: r.over_limit for r in found}[5] is False
    assert {r.doc_id: r.over_limit for r in found}[6] is True
    assert token_count.count_tokens(docs.limit(0)).collect() == []


def test_op11_on_documents(spark, library):
    from ledgermill.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, SF).collect()}
    expected = library.encode_batch(list(texts.values()), add_special_tokens=False)
    assert {k: r.n_tokens for k, r in found.items()} == dict(zip(texts, (len(e.ids) for e in expected)))
    assert {k: r.n_bytes for k, r in found.items()} == {k: len(t.encode()) for k, t in texts.items()}


# --- vector codes -----------------------------------------------------------------------

def nearest_plain(book, q):
    return min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))


@pytest.mark.parametrize("spread,width", [(3, 2), (50, 4), (5000, 8), (2**40, 3), (4, 1)])
def test_tree_finds_what_comparing_all_finds(spread, width):
    rng = random.Random(spread)
    for n in (1, 2, 4, 5, 16, 60, 256):
        points = [[rng.randrange(-spread, spread) for _ in range(width)] for _ in range(n)]
        points += points[: n // 3]  # repeated entries tie
        queries = points + [[rng.randrange(-spread, spread) for _ in range(width)] for _ in range(200)]
        kind = object if spread > 2**24 else np.int64
        found, best = vector_codes.Gnat(np.array(points, kind)).nearest(np.array(queries, kind))
        assert [(int(b), int(f)) for b, f in zip(best, found)] == [nearest_plain(points, q) for q in queries]


def test_tree_leaves_out_distances(monkeypatch):
    rng, asked = np.random.default_rng(1), []
    centres = rng.integers(-4000, 4000, (16, 8)) * 4
    points = np.repeat(centres, 4, axis=0) + rng.integers(-20, 20, (64, 8))
    queries = points[rng.integers(0, 64, 500)] + rng.integers(-10, 10, (500, 8))
    tree, plain = vector_codes.Gnat(points), vector_codes._squares
    monkeypatch.setattr(vector_codes, "_squares", lambda p, s: asked.append(len(p)) or plain(p, s))
    tree.nearest(queries)
    assert sum(asked) < 0.5 * len(points) * len(queries)


def codes_plain(rows, parts=8, entries=16, rounds=6):
    """{key: (code, error, label_error)} for rows (key, vector, label) of one width, and the books."""
    kept = [(k, [math.floor(4096 * x) for x in v], g) for k, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: r[0])
    size = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(nearest_plain(books[p], cut(v, p))[1], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e for k, e in enumerate(books[p])
            ]
    coded = {k: [nearest_plain(books[p], cut(v, p)) for p in range(parts)] for k, v, _ in kept}
    errors = {k: sum(d for d, _ in c) for k, c in coded.items()}
    labels = {}
    for k, _, g in kept:
        labels[g] = labels.get(g, 0) + errors[k]
    return {k: ("".join(f"{e:02x}" for _, e in coded[k]), errors[k], labels[g]) for k, _, g in kept}, books


def test_codes_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(16)], rng.choice([None, 1, 2])) for k in range(120)]
    rows += [(200, None, 1), (201, [math.nan] * 16, 1), (202, [0.1] * 15 + [None], 2), (203, [math.inf] * 16, None)]
    rows += [(300 + k, rows[5][1], 1) for k in range(40)]  # copies
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, row int")
    expected, books = codes_plain(rows)
    found = vector_codes.compress(df.repartition(5)).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in found} == expected and len(found) == len(expected)
    digest = vector_codes.Codebooks(16, books).digest()
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_codes_with_large_components(spark):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 5]) for _ in range(8)], k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected, _ = codes_plain(rows)
    found = {r.vec_id: (r.code, r.error, r.label_error) for r in vector_codes.compress(df).collect()}
    assert found == expected
    huge = spark.createDataFrame([(1, [1e14] * 8, 0), (2, [-1e14] * 8, 0), (3, [1e300] * 8, 0), (4, [0.0] * 8, 0)], df.schema)
    got = {r.vec_id: (r.code, r.error) for r in vector_codes.compress(huge).collect()}
    assert got == {1: ("00" * 8, 0), 2: ("01" * 8, 0), 4: ("02" * 8, 0)}  # 1e300 counts as non-finite


def test_codes_edge_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema)).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1)], schema)).collect() == []
    odd = spark.createDataFrame(
        [(1, [1.0] * 8, 1), (2, [2.0] * 8, 1), (2, [2.0] * 8, 1), (None, [3.0] * 8, None), (5, [1.0] * 16, None), (6, [1.0] * 3, 2), (7, [], 2)],
        schema,
    )
    found = sorted(vector_codes.compress(odd).collect(), key=lambda r: (r.vec_id or 99, r.error is None))
    assert [(r.vec_id, r.error is None) for r in found] == [
        (1, False), (2, False), (2, False), (5, True), (6, True), (7, True), (None, False)]
    empty = spark.createDataFrame([(1, [], 1), (2, [], 1)], schema)
    assert [(r.code, r.error) for r in vector_codes.compress(empty).collect()] == [("00" * 8, 0)] * 2


# --- lexical search ---------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked_plain(docs, items, k=50):
    words = [(i, WORD.findall((t or "").translate(LOWER))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        asked, scores = set(WORD.findall((text or "").translate(LOWER))), []
        for i, w in words:
            m = 50 + (50 * len(w) * n) // total
            score = sum(
                weight[t] * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in asked if t in w
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def docs_of(rng, n, words=40):
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "é", "X1", "ß"]
    heavy = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(i, rng.choice([" ", "-", "\x00", "\n"]).join(rng.choices(vocabulary, heavy, k=rng.choice([0, 1, 5, 30, 300])))) for i in range(n)]


@pytest.mark.parametrize("bucket,seeds", [(2048, 20_000), (7, 10), (1, 1)])
def test_search_against_plain_python(spark, monkeypatch, bucket, seeds):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "SEEDS", seeds)
    rng = random.Random(bucket)
    docs = docs_of(rng, 300)
    docs += [(1000 + k, docs[7][1]) for k in range(120)] + [(3, "w1 w2"), (3, "w1 w2"), (None, "w1 w30"), (900, None), (901, "!?")]
    docs += [(902, "w3 " * 200_000)]
    items = docs_of(rng, 12) + [(50, None), (51, "nothing here"), (7, "W1 w1 É"), (7, "W1 w1 É"), (None, "w2 w35")]
    table = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, key int, terms int").repartition(3)
    queries = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    found = lexical.search(table, queries, k=20).collect()
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=str)
    assert got == ranked_plain(docs, items, 20)


def test_search_in_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", 3)
    rng = random.Random(8)
    docs, items = docs_of(rng, 60), docs_of(rng, 8)
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=str) == ranked_plain(docs, items)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    assert lexical.search(docs, items.limit(0)).collect() == []
    assert lexical.search(docs.select("doc_id", docs.text.substr(9, 1).alias("text")), items).collect() == []
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == ranked_rows_of_one()


def ranked_rows_of_one():
    return ranked_plain([(1, "a b")], [(1, "a")])
