"""Rows without ids, repeated ids with different texts, clashing names: every row is judged by itself, in operators and stages."""

import random

import duckdb
import pytest

import brute
import corpus_pipeline
from fraudlens.llm import lines as line_module, queries
from fraudlens.llm.common import table
from fraudlens.llm.decontaminate import contamination
from fraudlens.llm.lines import line_dedup
from fraudlens.llm.simhash import simhash_dedup, simhash_groups
from fraudlens.llm.tokencount import count_tokens
from fraudlens.llm.toxicity import score_toxicity, train_toxicity

SF = "/root/testdata/sf0.001"
CLASHES = "__id string, __scored int, row string, name string, id string, fp long, c0 string, n_lines string, score string, kept string, lines string, w string, doc string"


@pytest.fixture(scope="module")
def rows():
    """``(id, text)``: ids missing, repeated, beyond 2^53; texts null, empty, long, near and exact copies."""
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in "bdgkmt" for b in "aeiou" for c in "lnrst"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    shared, passage = prose(12), duckdb.sql(f"SELECT text FROM read_parquet('{SF}/benchmark.parquet') WHERE length(text) > 200 LIMIT 1").fetchall()[0][0]
    out = [
        (None, f"{prose(9)}\n{prose(8)}\n{shared}"), (None, f"{prose(9)}\n{prose(8)}\n{prose(7)}\n{shared}"), (None, f"{prose(9)}\n{prose(10)}\n{prose(11)}"),
        (5, f"{shared}\n{prose(9)}"), (5, f"{prose(8)}\n{shared}"), (5, prose(6)), (2**60 + 1, prose(20)), (2**60 + 3, prose(20)),
        (None, None), (None, ""), (8, None), (8, ""), (9, "  \n\n"), (None, passage), (None, "two words"), (11, passage), (11, prose(15)), (12, prose(30_000)),
    ]
    copy, near = prose(40), prose(120).split()
    out += [(20, copy), (20, copy), (None, copy), (None, copy), (19, copy)]
    out += [(30 + i, " ".join(near[:60 + i] + ["extra"] + near[60 + i:])) for i in range(4)] + [(None, " ".join(near))]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    kinds = f"doc_id long, text string, lang string, source string, n_chars int, {CLASHES}"
    extra = (None, 7, "r", None, "i", 3, "c", "many", "high", "k", "l", "w", "d")
    data = [(d, t, None if i % 3 else "en", f"s{i}", len(t) if t and i % 4 else None, *extra) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(data, kinds).coalesce(1)


def ranked(rows):
    """The rows' places in the order of ids, missing ones first, and in the order they are read."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    return {i: k for k, i in enumerate(order)}


def lines_of(rows):
    place = ranked(rows)
    found = brute.lines([(place[i], t) for i, (_, t) in enumerate(rows)])
    return [found[place[i]] for i in range(len(rows))]


def test_lines(docs, rows):
    found = line_dedup(docs)
    assert found.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_removed"]
    got = sorted((int(r["source"][1:]), r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in found.collect())
    assert [g[1:] for g in got] == [(d, *want) for (d, _), want in zip(rows, lines_of(rows))]


def test_contamination(spark, docs, rows):
    items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
    want = brute.contamination(list(enumerate(t for _, t in rows)), items)
    benchmark = table(spark, SF, "benchmark")
    for limit in (32 << 20, 0):
        found = contamination(docs, benchmark, id_col="source", broadcast_bytes=limit)
        assert {int(r["source"][1:]): (r["n_words"], r["hit_words"], r["items"]) for r in found.collect()} == want
    by_id = sorted(((r["doc_id"] or -1, r["n_words"], r["hit_words"]) for r in contamination(docs, benchmark).collect()))
    assert by_id == sorted((d or -1, *want[i][:2]) for i, (d, _) in enumerate(rows))


def prints_of(rows):
    """Fingerprint and members of the group of each row."""
    found = brute.simhash([(i, t) for i, (_, t) in enumerate(rows)])
    group = {}
    for i, (_, root) in found.items():
        group.setdefault(root, []).append(i)
    return {i: (fp, group[root]) for i, (fp, root) in found.items()}


def test_simhash(docs, rows):
    want = prints_of(rows)
    ids = [(d, fp, min((rows[j][0] for j in group if rows[j][0] is not None), default=None)) for (d, _), (fp, group) in zip(rows, want.values())]
    got = [tuple(r) for r in simhash_groups(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, ids))
    text_ids = simhash_groups(docs, id_col="source")
    assert {r["source"]: r["component_id"] for r in text_ids.collect()} == {f"s{i}": min(f"s{j}" for j in group) for i, (_, group) in want.items()}


def test_simhash_dedup(docs, rows):
    kept = simhash_dedup(docs)
    assert kept.columns == docs.columns
    first = {min(group, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, j)) for _, group in prints_of(rows).values()}
    assert {int(r["source"][1:]) for r in kept.collect()} == first


def test_scores(spark, docs, rows):
    labels = spark.createDataFrame([(5, 1), (20, 0), (20, 0), (12, 0), (None, 1)], "doc_id long, toxic int")
    found = score_toxicity(docs, train_toxicity(docs, labels))
    assert found.columns == [*(c for c in docs.columns if c != "score"), "score"]
    got = {int(r["source"][1:]): r for r in found.collect()}
    assert [got[i]["doc_id"] for i in range(len(rows))] == [d for d, _ in rows]
    assert len({got[i]["score"] for i, (_, t) in enumerate(rows) if not (t or "").strip()}) == 1
    assert got[18]["score"] == got[19]["score"] and got[0]["__scored"] == 7
    assert docs.select(queries.held_out()).filter("doc_id IS NULL").distinct().collect()[0][0] is False


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.word_bpe())
    found = [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in count_tokens(docs, queries.word_bpe).collect()]
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted(map(str, found)) == sorted(map(str, want))


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, docs, rows, stage):
    name, run = corpus_pipeline.STAGES[stage]
    done = run(spark, docs, SF)
    empty = run(spark, docs.limit(0), SF)
    assert empty.collect() == []
    if stage == 4:
        assert done.count() == len(rows) and done.filter("doc_id IS NULL").count() == sum(d is None for d, _ in rows)
        return
    assert done.dtypes == docs.dtypes and empty.dtypes == docs.dtypes
    kept = {int(r["source"][1:]): r for r in done.collect()}
    before = {int(r["source"][1:]): r for r in docs.collect()}
    if name == "line_dedup":
        found = lines_of(rows)
        assert set(kept) == {i for i, (n, gone, _) in enumerate(found) if n == 0 or gone < n}
        for i, r in kept.items():
            n, gone, text = found[i]
            want = before[i].asDict() | {"text": text, "n_chars": len(text) if gone else before[i]["n_chars"]}
            assert r.asDict() == want
        return
    assert all(r == before[i] for i, r in kept.items())
    if name == "simhash":
        assert set(kept) == {min(g, key=lambda j: (rows[j][0] is None, rows[j][0] or 0, j)) for _, g in prints_of(rows).values()}
    if name == "decontamination":
        items = duckdb.sql(f"SELECT item_id, text FROM read_parquet('{SF}/benchmark.parquet')").fetchall()
        want = brute.contamination(list(enumerate(t for _, t in rows)), items)
        assert set(kept) == {i for i in want if not want[i][1]} and {13, 15} == set(before) - set(kept)


def test_stages_with_repeated_rows(spark, docs):
    twice = docs.union(docs)
    kept = {name: run(spark, twice, SF).count() for name, run in corpus_pipeline.STAGES}
    once = {name: run(spark, docs, SF).count() for name, run in corpus_pipeline.STAGES}
    assert kept["simhash"] == once["simhash"]
    assert all(kept[name] == 2 * once[name] for name in ("toxicity", "decontamination", "byte_bpe"))
    assert kept["line_dedup"] == once["line_dedup"] + docs.filter("coalesce(trim(replace(text, chr(10), '')), '') = ''").count()


def test_template_lines(spark, monkeypatch):
    """Lines that share a stem but are not similar: what is compared grows with the lines, not with their square."""
    rng = random.Random(1)
    stem = "the quarterly statement of the account was sent to the address that the customer gave"
    made = {}
    write = line_module.settle

    def counted(df, label):
        out = write(df, label)
        made[label] = out.count()
        return out

    monkeypatch.setattr(line_module, "settle", counted)
    n = 12_000
    rows = [(i, f"{stem} {''.join(rng.choices('abcdefghijklmnopqrstuvwxyz0123456789', k=19))}") for i in range(n)]
    rows += [(n + i, text[:-1] + "!") for i, (_, text) in enumerate(rows[:50])]  # near copies among them
    found = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r["doc_id"] for r in found.filter("n_removed > 0").collect()} == set(range(n, n + 50))
    assert made["rest"] < 20 * n and made["groups"] < 20 * n


@pytest.mark.parametrize("least, most, wanted", [(40, 90, 1500), (330, 560, 1000), (600, 900, 600)])
def test_recall(spark, least, most, wanted):
    """Pairs of short, middling and long lines at a similarity of 0.8 to 0.82: the share that is found."""
    rng = random.Random(3)
    rows, pairs = [], []
    while len(pairs) < wanted:
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=rng.randint(least, most))).strip()
        other = list(line)
        for _ in range(round(len(other) * rng.uniform(0.015, 0.035))):
            other[rng.randrange(len(other))] = rng.choice("0123456789")
        other = "".join(other).strip()
        a, b = brute.char_shingles(line.encode()), brute.char_shingles(other.encode())
        if 0.8 <= len(a & b) / len(a | b) <= 0.82:
            pairs.append(len(rows))
            rows += [(len(rows), line), (len(rows) + 1, other)]
    found = {r["doc_id"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_removed > 0").collect()}
    assert found <= {i + 1 for i in pairs}
    assert len(found) >= 0.98 * len(pairs)  # by arithmetic 0.9961 and more
