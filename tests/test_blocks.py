"""Mini-batch blocks and bucketed propagation."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.blocks import block_mean, sampled_blocks, seed_batches
from fraudlens.operators.bucketed import BucketedGraph, write_bucketed
from fraudlens.operators.graph import propagate, propagate_k
from fraudlens.session import settle

FIRST = 40  # entities come before


def bipartite(seed=5, n=200):
    """Entity 0 is in a third of all transactions, 39 in none."""
    rng = random.Random(seed)
    edges = set()
    for t in range(FIRST, FIRST + n):
        for e in {0 if t % 3 == 0 else rng.randrange(FIRST - 1), rng.randrange(FIRST - 1)}:
            edges |= {(e, t), (t, e)}
    return sorted(edges)


@pytest.fixture(scope="module")
def graph(spark):
    edges = bipartite()
    rng = random.Random(1)
    nodes = [(i, [rng.random(), rng.random()]) for i in range(FIRST + 200)]
    return settle(spark.createDataFrame(nodes, "node_id long, feat array<double>")), settle(spark.createDataFrame(edges, "src long, dst long")), edges, dict(nodes)


def draw(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def plain_blocks(edges, seeds, fan_outs, size, seed):
    order = sorted(seeds, key=lambda n: (draw(n, seed), n))
    blocks, names = set(), {}
    for b in range(0, len(order), size):
        found = {n: 0 for n in order[b:b + size]}
        frontier = set(found)
        for hop, fan in enumerate(fan_outs, 1):
            reached = set()
            for d in frontier:
                ends = sorted((draw(s, d, seed + hop - 1), s) for s, t in edges if t == d)[:fan]
                blocks |= {(b // size, hop, s, d) for _, s in ends}
                reached |= {s for _, s in ends}
            for s in reached:
                found.setdefault(s, hop)
            frontier = reached
        for i, n in enumerate(sorted(found, key=lambda n: (found[n], n))):
            names[b // size, n] = (found[n], i)
    return blocks, names


@pytest.mark.parametrize("fan_outs, size", [((32, 32), 64), ((3, 2, 2), 7), ((1,), 1000)])
def test_blocks(spark, graph, fan_outs, size):
    _, frame, edges, _ = graph
    seeds = list(range(FIRST, FIRST + 200, 3))
    blocks, local = sampled_blocks(frame, spark.createDataFrame([(s,) for s in seeds], "node_id long"), fan_outs, size, 9)
    want, names = plain_blocks(edges, seeds, fan_outs, size, 9)
    assert {(r["batch"], r["node_id"]): (r["hop"], r["local_id"]) for r in local.collect()} == names
    rows = blocks.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["batch"], r["hop"], r["src"], r["dst"]) in want
        assert (r["src_id"], r["dst_id"]) == (names[r["batch"], r["src"]][1], names[r["batch"], r["dst"]][1])


def test_hub_comes_once_into_a_batch(spark, graph):
    _, frame, edges, _ = graph
    seeds = frame.filter("src = 0").select(F.col("dst").alias("node_id"))
    blocks, _ = sampled_blocks(frame, seeds, (4, 4), 16)
    of_hub = blocks.filter("hop = 2 AND dst = 0").groupBy("batch").count().collect()
    assert of_hub and all(r["count"] == 4 for r in of_hub)
    assert seed_batches(seeds, 16).groupBy("batch").count().filter("count > 16").isEmpty()


def test_block_mean(spark, graph):
    nodes, frame, _, feats = graph
    seeds = spark.createDataFrame([(s,) for s in (*range(FIRST, FIRST + 30), 39)], "node_id long")  # 39 has no neighbours
    blocks, local = sampled_blocks(frame, seeds, (5, 5), 8, 2)
    rows = [tuple(r)[:4] for r in blocks.collect()]
    first = local.filter("hop = 0").select("batch", "node_id")

    def mean(vectors):
        return [sum(v[k] for v in vectors) / len(vectors) for k in (0, 1)] if vectors else [0.0, 0.0]

    for limit in (1 << 20, 0):
        for r in block_mean(nodes, settle(blocks), first, 2, broadcast_bytes=limit).collect():
            inner = lambda n: mean([feats[s] for b, h, s, d in rows if (b, h, d) == (r["batch"], 2, n)])
            assert r["feat"] == pytest.approx(mean([inner(s) for b, h, s, d in rows if (b, h, d) == (r["batch"], 1, r["node_id"])]))


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_bucketed_propagation(spark, graph, limit):
    nodes, edges, _, _ = graph
    written = BucketedGraph.write(nodes, edges, FIRST, buckets=4)
    got = {r["node_id"]: r["feat"] for r in written.propagate_k(nodes, 2, 2, broadcast_bytes=limit).collect()}
    for r in propagate_k(nodes, edges, 2, 2).collect():
        assert got[r["node_id"]] == pytest.approx(r["feat"], abs=1e-12)
    assert len(got) == nodes.count() == propagate(nodes, edges, 2).count()


def exchanged(df):
    """What the plan exchanges: the output columns of every shuffle."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_edges_stay_where_they_lie(spark, graph):
    nodes, edges, _, _ = graph
    written = BucketedGraph.write(nodes, edges, FIRST, buckets=4)
    txn, entities = written.hop_frames(*written.place(nodes), 2)
    assert exchanged(txn) == []
    moved = exchanged(entities)  # partial sums of entities, and the entities themselves
    assert all("hashpartitioning(dst" in line or "hashpartitioning(node_id" in line for line in moved) and len(moved) <= 2
    with pytest.raises(ValueError):
        BucketedGraph.write(nodes, edges.union(spark.createDataFrame([(0, 1)], "src long, dst long")), FIRST)


def test_write_bucketed_keeps_rows(spark):
    rows = spark.range(1000).withColumn("k", F.when(F.col("id") % 10 > 0, F.col("id") % 7))
    assert sorted(map(tuple, write_bucketed(rows, "k", 3, "t").collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
