"""Batched merge rounds against the tokenizers library and an exact round trip."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from fraudlens.llm import mergebpe, queries
from fraudlens.llm.mergebpe import MergeTable, WordEncoder, encode_by_merges

HARD = [
    "<|endoftext|>" * 3 + " a<|endoftext|> b <|endoftext|>", "\0<|endoftext|>", "<|endoftext", "a" * 5000, "ababab" * 300, "aaa" * 7 + "b", " " * 3000 + "x",
    "é" * 701, "\U0001F600" * 700, "한국어 텍스트", "\x1c\x85　x  \n\n y", "don't WE'LL 'S 's  it 's", "\U00032808 ͏x", "",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(queries.merge_bpe())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def table():
    return MergeTable(queries.merge_bpe())


def random_texts(n=400):
    rng = random.Random(3)
    return ["".join(rng.choice("aabeht é\n1.🙂'") for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("ordered, long_word", [(True, 1024), (True, 2), (False, 1 << 30)])
def test_rounds(library, table, ordered, long_word, monkeypatch):
    """Rounds that merge all places of a pair, a heap for every word, and rounds that merge one place."""
    assert table.ordered
    monkeypatch.setattr(table, "ordered", ordered)
    monkeypatch.setattr(mergebpe, "LONG_WORD", long_word)
    texts = [t[:800] for t in HARD] + random_texts()
    encode = WordEncoder(table)
    for _ in range(2):  # the second time from the cache
        assert [ids.tolist() for ids in encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_caches_turn_over(library, table, monkeypatch):
    monkeypatch.setattr(mergebpe, "CACHED", 5)
    monkeypatch.setattr(mergebpe, "LONG_TEXT", 40)
    monkeypatch.setattr(mergebpe, "FLAT", 30)
    encode, texts = WordEncoder(table), HARD + random_texts(60)
    for text in texts:
        assert encode([text, "a b"])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_all_characters(library, table):
    encode = WordEncoder(table)
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}b {chr(c)}{chr(c)}" for c in range(k, k + 4096) if not 0xD800 <= c < 0xE000) for k in range(0, 0x110000, 4096)]
    for text in texts:
        ids = encode([text])[0]
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert table.decode(ids).decode() == text


def test_decode_broken(library, table):
    """Tokens that end inside a character decode to replacement characters, as the library does it."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        ids = rng.integers(0, 50_257, 12)
        assert table.decode(ids).decode("utf-8", "replace") == library.decode(ids.tolist(), skip_special_tokens=False)
    assert table.decode(np.zeros(0, np.int64)) == b""


def test_documents(spark, library):
    texts = [None, *HARD, "the " * 300_000, "x" * 30_000] + random_texts(50)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "an id that repeats", "x", 1), (None, "none", "x", 1), (None, "none again", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, id int").repartition(3)
    found = encode_by_merges(docs, queries.merge_bpe)
    assert found.columns == ["doc_id", "ids", "decoded"]
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t, *_ in rows}
    want = [(d, ids[t], library.decode(ids[t], skip_special_tokens=False)) for d, t, *_ in rows]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
    assert [d for _, _, d in want] == [t or "" for _, t, *_ in rows]
    assert encode_by_merges(docs.limit(0), queries.merge_bpe).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        MergeTable(queries.word_bpe())


def test_query(spark, library):
    import duckdb

    import brute

    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in docs}
    want = {d: (len(i), brute.sha(",".join(map(str, i))), brute.sha(library.decode(i, skip_special_tokens=False))) for d, i in ids.items()}
    assert {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_merge_bpe"](spark, sf).collect()} == want
