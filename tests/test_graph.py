import math
import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import graph as g
from fraudlens.operators.entity import CARD_STATS, PAIR_STATS, entity_stats
from fraudlens.operators.ordering import first_seen_vocab, global_row_id

SPREAD = {"broadcast_bytes": 0}


@pytest.fixture(scope="module")
def tiny(spark):
    tx = spark.createDataFrame([(0, 10, "c7", "eA"), (1, 20, "c3", "eA")], "row_id long, t long, card string, email string")
    return tx, first_seen_vocab(tx, ["card"], ["t"]), first_seen_vocab(tx, ["email"], ["t"])


@pytest.mark.parametrize("tuning", [{}, SPREAD])
def test_edges(tiny, tuning):
    tx, cards, emails = tiny
    edges = g.build_edges_card_email(tx, cards, emails, "card", "email", **tuning)
    got = sorted((r.src, r.dst) for r in edges.collect())
    assert got == sorted([(0, 3), (3, 2), (3, 0), (2, 3), (1, 4), (4, 2), (4, 1), (2, 4)])


@pytest.mark.parametrize("tuning", [{}, SPREAD])
def test_propagate_hand_case(spark, tiny, tuning):
    tx, cards, emails = tiny
    edges = g.build_edges_card_email(tx, cards, emails, "card", "email")
    nodes = spark.createDataFrame([(i, [float(i + 1)]) for i in range(5)], "node_id long, feat array<double>")
    out = g.propagate(nodes, edges, 1, **tuning).orderBy("node_id").collect()
    assert [round(r.feat[0], 6) for r in out] == [2.828427, 3.535534, 4.5, 2.207107, 2.914214]


def random_graph(spark, n=60, m=400, seed=3):
    """Node 0 is the source of a third and the target of a third of the edges; some nodes are isolated."""
    rng = random.Random(seed)
    edges = []
    for i in range(m):
        a, b = rng.randrange(n - 5), rng.randrange(n - 5)
        edges.append((0 if i % 3 == 0 else a, 0 if i % 3 == 1 else b))
    feats = {i: [rng.random(), rng.random() - 0.5] for i in range(n)}
    return (
        spark.createDataFrame([(i, f) for i, f in feats.items()], "node_id long, feat array<double>"),
        spark.createDataFrame(edges, "src long, dst long").repartition(6),
        feats,
        edges,
    )


def brute_hop(feats, edges):
    out_deg, in_deg = {}, {}
    for u, v in edges:
        out_deg[u] = out_deg.get(u, 0) + 1
        in_deg[v] = in_deg.get(v, 0) + 1
    new = {i: [0.0, 0.0] for i in feats}
    for u, v in edges:
        for d in range(2):
            new[v][d] += feats[u][d] / math.sqrt(out_deg[u] * in_deg[v])
    return new


@pytest.mark.parametrize("tuning", [{}, SPREAD])
def test_propagation_against_brute_force(spark, tuning):
    nodes, edges, feats, pairs = random_graph(spark)
    one, two = brute_hop(feats, pairs), brute_hop(brute_hop(feats, pairs), pairs)
    for r in g.propagate_k(nodes, edges, 2, 2, **tuning).collect():
        assert r.feat == pytest.approx(feats[r.node_id] + one[r.node_id] + two[r.node_id], abs=1e-9)


def test_propagation_is_linear(spark):
    nodes, edges, *_ = random_graph(spark)
    double = nodes.withColumn("feat", F.transform("feat", lambda x: 2 * x))
    a = {r.node_id: r.feat for r in g.propagate(nodes, edges, 2).collect()}
    for r in g.propagate(double, edges, 2).collect():
        assert r.feat == pytest.approx([2 * x for x in a[r.node_id]], abs=1e-9)


def test_no_edges_keeps_nodes(spark):
    nodes, edges, *_ = random_graph(spark)
    out = g.propagate(nodes, edges.limit(0), 2).collect()
    assert len(out) == 60 and all(r.feat == [0.0, 0.0] for r in out)
    assert g.degrees(nodes, edges.limit(0)).agg(F.sum("in_degree")).first()[0] == 0


def test_neighbour_sample(spark):
    nodes, edges, feats, pairs = random_graph(spark)
    sampled = g.sample_neighbors(edges, 5)
    counts = {}
    for _, v in pairs:
        counts[v] = counts.get(v, 0) + 1
    got = {r.dst: r["count"] for r in sampled.groupBy("dst").count().collect()}
    assert got == {v: min(5, n) for v, n in counts.items()}
    assert sampled.exceptAll(edges).isEmpty()
    again = g.sample_neighbors(edges.repartition(11), 5)
    assert again.exceptAll(sampled).isEmpty()
    means = {r.node_id: r.feat for r in g.sage_mean(nodes, edges, 2).collect()}
    for v in feats:
        near = [feats[u] for u, w in pairs if w == v]
        want = [sum(x[d] for x in near) / len(near) if near else 0.0 for d in range(2)]
        assert means[v] == pytest.approx(want, abs=1e-9)
    assert g.sage_hops(nodes, edges, 2, (5, 5)).count() == 60


def test_sample_is_reduced_before_the_shuffle(spark):
    _, edges, *_ = random_graph(spark)
    plan = g.sample_neighbors(edges, 32)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(dst"):]
    assert "WindowGroupLimit" in before_shuffle


KEYS = {"card": ["card"], "email": ["email"], "device": ["dev"]}


def test_hetero_graph(spark):
    tx = spark.createDataFrame(
        [(1, 1.0, 5, "a", "x", "p", 1), (2, 2.0, 6, "b", "x", None, 0), (3, None, 7, "a", "y", "q", 0)],
        "id long, TransactionAmt double, TransactionDT long, card string, email string, dev string, isFraud int",
    )
    train = global_row_id(tx, ["TransactionDT", "id"])
    vocabs = {n: first_seen_vocab(train.na.drop(subset=k), k, ["TransactionDT", "id"]) for n, k in KEYS.items()}
    edges = g.build_edges_hetero(train, vocabs, KEYS)
    assert edges.count() == 2 * (3 + 3 + 2)  # the second transaction has no device
    backwards = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "etype", "feat")
    assert edges.exceptAll(backwards).isEmpty()
    assert edges.filter("feat[0] = 0.0").count() == 6
    stats = {n: entity_stats(train, k, stats=CARD_STATS if n == "card" else PAIR_STATS, missing=None) for n, k in KEYS.items()}
    nodes = {r.node_id: r for r in g.node_features(train, vocabs, stats, KEYS).collect()}
    assert len(nodes) == 2 + 2 + 2 + 3 and all(len(r.feat) == 64 for r in nodes.values())
    assert nodes[0].feat[:4] == [1.0, 1.0, 0.5, 1.0] and nodes[2].feat[4:7] == [1.5, 2.0, 0.5]
    assert nodes[4].ntype == "device" and nodes[4].feat[7:10] == [1.0, 1.0, 1.0]
    assert nodes[6].ntype == "txn" and nodes[6].feat[:2] == [1.0, 5.0] and nodes[8].feat[:2] == [0.0, 7.0]
    table = g.node_ids(vocabs, KEYS, train)
    assert tuple(g.offsets(table).first()) == (6, 9)
    assert sorted((r.node_id, r.isFraud) for r in g.node_labels(table, train, "isFraud", 6).collect()) == [(6, 1), (7, 0), (8, 0)]
    assert {r.kind: r.n for r in g.graph_summary(table, edges).collect()} == {"card": 2, "email": 2, "device": 2, "txn": 3, "edges": 16}


def test_test_graph_uses_training_ids(spark, tiny):
    _, cards, emails = tiny
    test = spark.createDataFrame([(5, "c3", "eA"), (6, "new", "eA"), (4, "c7", "eA")], "t long, card string, email string")
    kept, edges, report = g.build_test_graph(test, cards, emails, ["t"], "card", "email")
    assert [(r.t, r.row_id) for r in kept.orderBy("t").collect()] == [(4, 0), (5, 1)]
    assert edges.count() == 8 and tuple(report.first()) == (3, 2, 1)
    assert {r.dst for r in edges.filter("src = 1").collect()} == {4}


def test_txn_features_and_mse(spark):
    df = spark.createDataFrame([("a", "p", 2.0), ("z", "p", None)], "card string, dev string, TransactionAmt double")
    cards = spark.createDataFrame([("a", [1.0, 2.0])], "card string, emb array<double>")
    devs = spark.createDataFrame([("p", [3.0, 4.0])], "dev string, emb array<double>")
    out = g.txn_features(df, cards, devs, ["card"], ["dev"], 2, ["TransactionAmt", "V1"]).orderBy("card").collect()
    assert [r.features for r in out] == [[2.0, 0.0, 1.0, 2.0, 3.0, 4.0], [0.0, 0.0, 0.0, 0.0, 3.0, 4.0]]
    nodes = spark.createDataFrame([([1.0, 2.0], [0.0, 0.0, 9.0])], "emb array<double>, feat array<double>")
    assert g.reconstruction_mse(nodes, "emb", "feat", 2).first()[0] == 2.5
    assert g.cooccurrence(df, ["card"], ["dev"]).count() == 2
