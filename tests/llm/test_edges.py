"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names and hot groups."""

import random
import textwrap

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from fraudlens.llm import lines as line_module, packed, queries, suffix, vectors
from fraudlens.llm.bytebpe import Codec, Encoder, encode_documents, read_ranks
from fraudlens.llm.components import components
from fraudlens.llm.decontaminate import contamination
from fraudlens.llm.licence_texts import TEXTS
from fraudlens.llm.licences import licence_matches, licence_scan
from fraudlens.llm.lines import line_dedup
from fraudlens.llm.simhash import near_links, simhash_groups
from fraudlens.llm.substring import substring_dedup
from fraudlens.llm.suffix import suffix_dedup
from fraudlens.llm.tokencount import count_tokens
from fraudlens.llm.toxicity import Model, Scorer, score_toxicity, train, train_toxicity
from fraudlens.llm.vectors import vector_groups

WORDS = "the of and thing other éclair straße ñandú zwei drei pan tion ing".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "x", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, line = sentence(rng, 60), sentence(rng, 12)
    out = [None, "", "   \n\t\n", "one", "one", "ä" * 70, "\n".join([line] * 4), sentence(rng, 4000), "a " * 500, "x" * 3000]
    out += [sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 25) for _ in range(6)]
    out += [line + "\n" + sentence(rng, 40).upper() for _ in range(5)]
    return [(10 + i, t) for i, t in enumerate(out + out[8:12])]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Documents with columns whose names clash with those the operators use inside."""
    rows = [(d, t, "x", 1.5, "c", 7) for d, t in texts]
    return spark.createDataFrame(rows, "doc_id long, text string, doc string, score double, c0 string, n_lines long").repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def as_map(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_substring(docs, none, texts):
    assert as_map(substring_dedup(docs)) == brute.windows(texts)
    assert as_map(substring_dedup(docs, 3)) == brute.windows(texts, 3)
    assert substring_dedup(none).collect() == []


@pytest.mark.parametrize("hot", [1_000, 2])
def test_suffix(docs, none, texts, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    for length in (50, 32):
        found = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in suffix_dedup(docs, length).collect()}
        assert found == brute.byte_strings(texts, length)
    assert suffix_dedup(none).collect() == []


def test_suffix_order():
    rng = np.random.default_rng(3)
    for letters in (1, 2, 4):
        data = np.concatenate([rng.integers(97, 97 + letters, 3000, dtype=np.uint8), np.zeros(128, np.uint8)])
        at = np.sort(rng.choice(2900, 1500, replace=False))
        got = np.concatenate(list(suffix.sorted_blocks(data, at, 50, most=200)))
        raw = data.tobytes()
        assert sorted(got.tolist()) == at.tolist()
        keys = [raw[i:i + 50] for i in got]
        assert keys == sorted(keys)


def test_repeated_ids(spark):
    """Rows with one id are one document."""
    text = " ".join(f"w{i}" for i in range(40))
    twice = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substring_dedup(twice).collect()) == [0, 40, 40, 40]
    kept = sorted((r["doc_id"] or 0, len(r["kept"])) for r in suffix_dedup(twice).collect())
    assert kept == [(0, len(text)), (1, 0), (1, 0), (2, 0)]
    got = contamination(twice, spark.createDataFrame([(7, "w3 w4 w5")], "item_id long, text string"))
    assert [(r["hit_words"], r["items"]) for r in got.collect()] == [(3, ["7"])] * 4
    assert len(simhash_groups(twice).collect()) == 4
    assert sorted(r["n_removed"] for r in line_dedup(twice).collect()) == [0, 1, 1, 1]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_contamination(spark, docs, none, texts, limit):
    rng = random.Random(9)
    passage = next(t for _, t in texts if t and t.count("\n") == 2).split("\n")[1]
    items = [(1, passage), (2, " ".join(passage.split()[5:15])), (3, None), (4, ""), (5, "one"), (6, "The OTHER"), (7, sentence(rng, 30)), (8, passage)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {k: (n, h, list(i)) for k, (n, h, i) in as_map(contamination(docs, table, broadcast_bytes=limit)).items()}
    assert got == brute.contamination(texts, items)
    assert contamination(none, table).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r["hit_words"] for r in contamination(docs, empty).collect()} == {0}


def test_lines(spark, docs, none, texts):
    found = line_dedup(docs)
    assert found.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_removed"]
    want = brute.lines(texts)
    for r in found.collect():
        assert (r["n_lines"], r["n_removed"], r["text"]) == want[r["doc_id"]]
        assert (r["doc"], r["score"], r["c0"]) == ("x", 1.5, "c")
    assert line_dedup(none).collect() == []


def test_fuzzy_lines(spark, monkeypatch):
    """A large group of near copies, cut into tiles, against exact components."""
    rng = random.Random(2)
    base = [sentence(rng, 25) for _ in range(8)]
    rows = []
    for i in range(240):
        line = list(base[i % 8])
        for _ in range(rng.randint(0, 3)):
            line[rng.randrange(len(line))] = rng.choice("abcdefgh")
        rows.append((i, "".join(line) + "\n" + sentence(rng, 9)))
    monkeypatch.setattr(line_module, "TILE", 8)
    got = as_map(line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_lines", "n_removed", "text"))
    assert got == brute.lines(rows)


def test_candidates_of_a_large_group():
    """A bucket gives each line of a group once, however many parts the group is cut into."""
    n = 20_000
    rows = pa.table({
        "bucket": pa.array([3, 3], pa.int32()), "keys": [np.full(n, 7, np.uint64).tobytes(), np.full(4, 9, np.uint64).tobytes()],
        "ids": [np.arange(n, dtype=np.int64).tobytes(), np.arange(4, dtype=np.int64).tobytes()], "more": [b"", None],
    })
    found = line_module.candidates(rows, 256)
    assert found.num_rows == n + 4 and found.column("large").to_pylist() == [True] * (n + 4)


def test_many_near_lines(spark):
    """Tens of thousands of different near lines: one stays, and the tiles' rows follow the lines, not their square."""
    text = "the quarterly statement of account number {:06d} was sent to the address that the customer had given to the branch, with all enclosures"
    n = 30_000
    rows = spark.range(n, numPartitions=8).select(F.col("id").alias("doc_id"), F.format_string(text.replace("{:06d}", "%06d"), F.col("id")).alias("text"))
    made = []
    write = line_module.settle

    def counted(df, label):
        out = write(df, label)
        made.append((label, out.count()))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(line_module, "settle", counted)
        found = line_dedup(rows).agg(F.sum("n_lines"), F.sum("n_removed"), F.min(F.when(F.col("n_removed") == 0, F.col("doc_id")))).first()
    assert tuple(found) == (n, n - 1, 0)
    assert dict(made)["groups"] < 20 * n


def test_simhash(spark, docs, none, texts):
    assert as_map(simhash_groups(docs)) == brute.simhash(texts)
    assert simhash_groups(none).collect() == []


def test_near_prints(spark):
    """Distances up to three bits, in any blocks, also in cells that are cut."""
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:40]:
        for _ in range(6):
            flips = rng.sample(range(64), rng.randint(1, 5))
            prints.append(p ^ sum(1 << b for b in flips))
    prints = sorted(set(prints))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(signed, "doc long, fp long")
    want = brute.roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    for cell_rows in (4096, 3):
        links = [(r["u"], r["v"]) for r in near_links(frame, 3, cell_rows).collect()]
        assert brute.roots(len(prints), links) == want
    with pytest.raises(ValueError):
        near_links(frame, 4)


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 450)] + [(500, i) for i in range(501, 560)]
    want = brute.roots(600, links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 3)], "u long, v long")).collect()}
    assert got == {n: want[n] for n in {x for a, b in links if a != b for x in (a, b)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("tile", [1024, 4])
def test_vectors(spark, tile, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", tile)
    monkeypatch.setattr(vectors.vector_links, "__defaults__", (tile,))
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(size=12) * 0.25).tolist(), i % 2 if i % 11 else None) for i in range(60)]
    rows += [(60, None, 1), (61, [], 1), (62, [0.0] * 12, 1), (63, [float("nan")] + [1.0] * 11, 1), (64, [None] + [1.0] * 11, 1), (65, [float("inf")] * 12, 1)]
    rows += [(66 + k, rows[3][1], rows[3][2]) for k in range(4)] + [(70, [1e300] * 12, 0), (71, [1e-300] * 12, 0), (72, [1.0] * 3, 0)]
    data = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, id string")
    want = brute.vectors([r for r in rows if r[0] not in (70, 71)] + [(70, [1.0] * 12, 0), (71, [1.0] * 12, 0)])
    got = vector_groups(data).collect()
    assert sorted(tuple(r)[:3] for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert vector_groups(data.limit(0)).collect() == []


def test_quantisation_bound():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(200, 40))
    rows[:50] *= np.logspace(-8, 8, 50)[:, None]
    rows[50:100, 0] *= 1e4
    q = vectors.Quantised(rows)
    exact = q.unit @ q.unit.T
    for least in (0.0, 0.3, 0.93):
        assert vectors.possible(q, q, least)[exact >= least].all()
    assert (vectors.links_of(q, q, 0.2) == (exact >= 0.2)).mean() > 0.9999


def test_byte_bpe(docs, none, texts):
    ranks = read_ranks(queries.byte_bpe())
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = encode_documents(docs, queries.byte_bpe, public_tokenizers.PATTERN)
    assert {r["doc_id"]: (r["ids"], bytes(r["decoded"])) for r in found.collect()} == {d: (tik.encode_ordinary(t or ""), (t or "").encode()) for d, t in texts}
    assert encode_documents(none, queries.byte_bpe, public_tokenizers.PATTERN).collect() == []
    encoder, rng = Encoder(Codec(ranks), public_tokenizers.PATTERN), random.Random(3)
    hard = ["a" * 5000, "ababab" * 300, "the" * 999, "한국어 텍스트", "🙂🙃" * 40, "\x1c\x85 　x", "é" * 50]
    hard += ["".join(rng.choice("aabeht é\n1.") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for text in hard:
        ids, decoded = encoder(text)
        assert np.frombuffer(ids, np.int32).tolist() == tik.encode_ordinary(text) and decoded == text.encode()


def test_token_counts(docs, none, texts, spark):
    library = Tokenizer.from_file(queries.word_bpe())
    special = [(100, "<|startoftext|>Hi <|endoftext|>"), (101, "ΑΣ ΣΑΣ İx Ｆｕｌｌ"), (102, "éa​b"), (103, "<|ENDOFTEXT|> <|"), (104, "\U00032808 x")]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(special, "doc_id long, text string"))
    want = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in texts + special}
    assert {d: r[1] for d, r in as_map(count_tokens(both, queries.word_bpe)).items()} == want
    assert count_tokens(none, queries.word_bpe).collect() == []


def test_licences(spark, docs, none):
    rows = [
        (1, "intro\nReleased under the MIT licence\nmore text here"), (2, "released under, the MIT license!"), (3, None), (4, ""),
        (5, "Licensed under CC BY-NC 4.0.\nAll rights reserved."), (6, queries.TEMPLATES[5][1].replace(". ", ".\n").replace("merge", "join")),
    ]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_notices"], r["licences"]) for r in licence_scan(data).collect()}
    assert got == {1: (0, []), 2: (1, ["mit"]), 3: (0, []), 4: (0, []), 5: (2, ["all-rights-reserved", "cc-by-nc-4.0"]), 6: (1, ["mit"])}
    assert [r["unit"] for r in licence_matches(data.filter("doc_id = 6")).collect()] == [-1]
    assert licence_scan(none).collect() == []
    assert licence_scan(docs).count() == docs.count()


def test_licence_runs(spark):
    """Whole, wrapped and embedded licences; prose that shares words with one has none."""
    whole = {}
    for name, text in TEXTS:
        whole.setdefault(name, text)
    filler = "some prose of no interest at all " * 30
    notice, gpl = queries.TEMPLATES[2][1], next(t for k, t in queries.TEMPLATES if k == "gpl-3.0" and t.startswith("This program"))
    texts = [
        "\n".join(textwrap.wrap(whole["bsd"], 70)), "Copyright 2020 A. Author\n" + "\n".join(textwrap.wrap(whole["isc"], 60)) + "\n" + filler,
        "\n".join(textwrap.wrap(notice, 70)) + "\n\n" + filler, filler + gpl + " " + filler, "\n".join(textwrap.wrap(whole["gpl-3.0"], 75)),
        filler + "\n" + whole["apache-2.0"], filler + "the license and the software are permitted in all copies",
    ]
    got = {r["doc_id"]: (r["n_notices"], r["licences"]) for r in licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [set(got[i][1]) >= {k} for i, k in enumerate(["bsd", "isc", "apache-2.0", "gpl-3.0", "gpl-3.0", "apache-2.0"])] == [True] * 6, got
    assert all(got[i][0] > 0 for i in range(6)) and got[6] == (0, [])


def test_toxicity(spark, docs, none, texts):
    labels = spark.createDataFrame([(d, d % 2) for d, _ in texts] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = train_toxicity(docs, labels, toxic_rows=6, clean_rows=6)
    found = score_toxicity(docs, model)
    assert sorted(found.columns) == sorted(docs.columns)
    score = Scorer(model)
    want = dict(texts)
    for r in found.collect():
        assert 0 <= r["score"] <= 1 and r["score"] == score([want[r["doc_id"]] or ""])[0] and r["c0"] == "c"
    assert score_toxicity(none, model).collect() == []
    one = train_toxicity(docs, labels.filter("toxic = 0"))
    assert Scorer(one)(["anything", ""]).tolist() == [pytest.approx(0.01)] * 2
    assert isinstance(train_toxicity(none, labels), Model) and isinstance(train([], np.zeros(0)), Model)


def test_packets():
    rng = np.random.default_rng(2)
    doc = np.sort(rng.integers(-5, 1 << 40, 300)) * rng.choice([1, 1 << 20], 1)
    bucket, data = rng.integers(0, 7, 300).astype(np.int32), rng.integers(0, 256, (300, 3), dtype=np.uint8)
    sent = packed.pack(4, bucket, doc, data)
    for b, d, ids, counts in zip(*(sent.column(c).to_pylist() for c in ("bucket", "data", "docs", "counts"))):
        assert (packed.unpack_docs(ids, counts) == doc[bucket == b]).all()
        assert (np.frombuffer(d, np.uint8).reshape(-1, 3) == data[bucket == b]).all()
