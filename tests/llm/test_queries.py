"""Registered corpus queries: against their SQL, the reference libraries, or brute force."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from check_oracle import connect, differences
from fraudlens.llm import queries
from fraudlens.llm.bytebpe import read_ranks
from fraudlens.llm.common import table
from fraudlens.llm.toxicity import Scorer, train_toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall()


@pytest.fixture(scope="module")
def tik():
    ranks = read_ranks(queries.byte_bpe())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, name):
    return {r[0]: tuple(r)[1:] for r in queries.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    found = differences(connect(SF), spark, SF, queries.QUERIES[name], queries.ORACLES[name])
    assert found == "" or found.startswith("(equal)"), found


def test_toxicity(spark, docs):
    found = rows(spark, "op1_toxicity")
    assert set(found) == {d for d, _ in docs}
    for d, (held, score, predicted) in found.items():
        assert held == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= score <= 1 and predicted == (score >= 0.7)
    assert rows(spark, "op1_toxicity") == found


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(queries.word_bpe())
    want = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in docs}
    assert rows(spark, "op4_token_counts") == {d: (len(t.encode()), want[d], want[d] > 2048) for d, t in docs}


def test_byte_bpe(spark, docs, tik):
    ids = {d: tik.encode_ordinary(t) for d, t in docs}
    want = {d: (len(ids[d]), brute.sha(",".join(map(str, ids[d]))), brute.sha(t)) for d, t in docs}
    assert rows(spark, "op8_byte_bpe") == want


def test_line_dedup(spark, docs):
    want = {d: (n, gone, brute.sha(text)) for d, (n, gone, text) in brute.lines(docs).items()}
    assert rows(spark, "op9_line_dedup") == want


def test_simhash(spark, docs):
    assert rows(spark, "op10_simhash_groups") == brute.simhash(docs)


def test_pipeline(spark, docs, tik):
    known = table(spark, SF, "labels").filter(~queries.held_out())
    score = Scorer(train_toxicity(table(spark, SF, "documents"), known))
    left = [(d, t) for d, t in docs if score([t])[0] < queries.TOXIC]
    lines = brute.lines(left)
    left = [(d, lines[d][2]) for d, _ in left if lines[d][0] == 0 or lines[d][1] < lines[d][0]]
    groups = brute.simhash(left)
    left = [(d, t) for d, t in left if groups[d][1] == d]
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    leaked = brute.contamination(left, items)
    left = [(d, t) for d, t in left if not leaked[d][1]]
    assert 0 < len(left) < len(docs)
    ids = {d: tik.encode_ordinary(t) for d, t in left}
    want = {d: (len(ids[d]), brute.sha(",".join(map(str, ids[d]))), brute.sha(t)) for d, t in left}
    assert {r[0]: tuple(r)[1:] for r in corpus_pipeline.run(spark, SF).collect()} == want


def test_stages_keep_columns(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, SF)
        assert done.columns == docs.columns and done.dtypes == docs.dtypes, name


def test_toxicity_is_learnt(spark):
    """Half of the held-out toxic words are misspelt forms that training never saw."""
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    texts, labels = [], []
    for i in range(600):
        words = list(rng.choice(plain, 40))
        if i % 2:
            words[int(rng.integers(40))] = str(rng.choice(["zorgling", "vexxing"] if i < 400 else ["zorglings", "vexxingly", "zorgling"]))
        texts.append(" ".join(words))
        labels.append(i % 2)
    data = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, labels))], "doc_id long, text string, toxic int")
    score = Scorer(train_toxicity(data.select("doc_id", "text"), data.filter("doc_id < 400").select("doc_id", "toxic")))
    held, toxic = score(texts[400:]), np.array(labels[400:], bool)
    assert (held[toxic][:, None] > held[~toxic]).mean() > 0.98
    assert score([""])[0] < 0.3
