"""Graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fraudlens import bindings as b
from fraudlens.functions.scalars import zero_default
from fraudlens.operators import graph as g
from fraudlens.operators.blocks import block_mean, sampled_blocks
from fraudlens.operators.bucketed import BucketedGraph
from fraudlens.operators.clean import add_simple_device, fill_categorical
from fraudlens.operators.entity import CARD_STATS, PAIR_STATS, entity_stats
from fraudlens.operators.joins import merge_identity
from fraudlens.operators.ordering import first_seen_vocab, global_row_id
from fraudlens.queries.base import ORDER, VIEWS, card_email_vocabs, named_email, numbered_train, query, split_txn, steady, steady_sql
from fraudlens.session import settle

HETERO_KEYS = {"card": ["card1", "card2", "card4"], "email": ["P_emaildomain"], "device": ["DeviceType", "DeviceInfo_simple"]}

# Graph with three entity types over the training rows
VIEWS["htrain"] = """
    SELECT train.* EXCLUDE (P_emaildomain), CASE WHEN P_emaildomain = 'missing' THEN 'unknown' ELSE P_emaildomain END AS P_emaildomain,
           coalesce(DeviceType, 'unknown') AS DeviceType, coalesce(split_part(lower(DeviceInfo), '/', 1), 'unknown') AS DeviceInfo_simple
    FROM train LEFT JOIN idn USING (TransactionID)"""
VIEWS["hcards"] = """
    SELECT card1, card2, card4, row_number() OVER (ORDER BY min(row_id)) - 1 AS node_id FROM htrain GROUP BY 1, 2, 3"""
VIEWS["hemails"] = """
    SELECT P_emaildomain, (SELECT count(*) FROM hcards) + row_number() OVER (ORDER BY min(row_id)) - 1 AS node_id FROM htrain GROUP BY 1"""
VIEWS["hdevices"] = """
    SELECT DeviceType, DeviceInfo_simple,
           (SELECT count(*) FROM hcards) + (SELECT count(*) FROM hemails) + row_number() OVER (ORDER BY min(row_id)) - 1 AS node_id
    FROM htrain GROUP BY 1, 2"""
VIEWS["hstart"] = """
    SELECT (SELECT count(*) FROM hcards) + (SELECT count(*) FROM hemails) + (SELECT count(*) FROM hdevices) AS start"""
VIEWS["hedges"] = """
    SELECT unnest([tx_node, entity]) AS src, unnest([entity, tx_node]) AS dst, etype, amt, dt FROM (
      SELECT start + row_id AS tx_node, unnest([c.node_id, e.node_id, v.node_id]) AS entity, unnest(['card', 'email', 'device']) AS etype,
             coalesce(TransactionAmt, 0.0) AS amt, CAST(TransactionDT AS DOUBLE) AS dt
      FROM htrain JOIN hcards c USING (card1, card2, card4) JOIN hemails e USING (P_emaildomain)
           JOIN hdevices v USING (DeviceType, DeviceInfo_simple), hstart)"""
# Node vectors of two small dimensions for propagation
VIEWS["nfeat"] = """
    SELECT idx AS node_id, ln(1 + n) AS x0, 0.5::DOUBLE AS x1 FROM cards
    UNION ALL SELECT n_cards + idx, ln(1 + n), -0.5::DOUBLE FROM emails, sizes
    UNION ALL SELECT n_cards + n_emails + row_id, coalesce(D1, 0.0) / 1000, CAST(C1 AS DOUBLE) FROM train, sizes"""
VIEWS["odeg"] = "SELECT src, count(*) AS d FROM edges GROUP BY src"
VIEWS["ideg"] = "SELECT dst, count(*) AS d FROM edges GROUP BY dst"


def hop_sql(source: str) -> str:
    """One propagation step over the two-dimensional node vectors of ``source``."""
    return f"""
    SELECT n.node_id, coalesce(h.x0, 0.0) AS x0, coalesce(h.x1, 0.0) AS x1 FROM {source} n LEFT JOIN (
      SELECT edges.dst, sum(s.x0 / sqrt(odeg.d)) / sqrt(max(ideg.d)) AS x0, sum(s.x1 / sqrt(odeg.d)) / sqrt(max(ideg.d)) AS x1
      FROM edges JOIN {source} s ON s.node_id = edges.src JOIN odeg ON odeg.src = edges.src JOIN ideg ON ideg.dst = edges.dst
      GROUP BY edges.dst) h ON h.dst = n.node_id"""


def small_graph(spark, d):
    """Training rows, vocabularies, node vectors and edges of the card/e-mail graph."""
    train = numbered_train(spark, d, "D1", "C1", "isFraud")
    cards, emails = card_email_vocabs(train)
    start = g.node_offsets(g.vocab_sizes({"card": cards, "email": emails}))
    weight = F.log1p(F.col("n").cast("double"))
    vec = lambda a, z: F.array(a.cast("double"), z.cast("double")).alias("feat")
    nodes = g.union_nodes(
        [
            cards.select(F.col("idx").alias("node_id"), vec(weight, F.lit(0.5))),
            emails.select((F.col("idx") + start["email"]).alias("node_id"), vec(weight, F.lit(-0.5))),
            train.select(
                (F.col("row_id") + start["txn"]).alias("node_id"), vec(zero_default(F.col("D1")) / 1000, F.col("C1"))
            ),
        ]
    )
    return train, cards, emails, settle(nodes, "nodes"), settle(g.build_edges_card_email(train, cards, emails), "edges")


def hetero_graph(spark, d):
    """Training rows with devices, the three vocabularies and profiles."""
    rows = split_txn(spark, d, "TransactionAmt", "isFraud", "card1", "card2", "card4", "P_emaildomain", "C1", "D1").filter("split = 'train'")
    rows = add_simple_device(merge_identity(rows, b.idn(spark, d)))
    rows = fill_categorical(rows, ["P_emaildomain", "DeviceType", "DeviceInfo_simple"], "unknown")
    train = global_row_id(rows, ORDER, "row_id")
    vocabs = {n: first_seen_vocab(train, keys, ORDER) for n, keys in HETERO_KEYS.items()}
    return train, vocabs


@query("g01_edges_card_email", "SELECT src, dst FROM edges")
def g01(spark, d):
    train = numbered_train(spark, d)
    cards, emails = card_email_vocabs(train)
    return g.build_edges_card_email(train, cards, emails)


@query("g02_edges_hetero", "SELECT src, dst, etype, amt, dt FROM hedges")
def g02(spark, d):
    train, vocabs = hetero_graph(spark, d)
    return g.build_edges_hetero(train, vocabs, HETERO_KEYS).select(
        "src", "dst", "etype", F.col("feat")[0].alias("amt"), F.col("feat")[1].alias("dt")
    )


@query("g03_nodes", """
    SELECT node_id, 'card' AS ntype, card1 || '_' || card2 || '_' || card4 AS key FROM hcards
    UNION ALL SELECT node_id, 'email', P_emaildomain FROM hemails
    UNION ALL SELECT node_id, 'device', DeviceType || '_' || DeviceInfo_simple FROM hdevices
    UNION ALL SELECT start + row_id, 'txn', CAST(row_id AS VARCHAR) FROM htrain, hstart""")
def g03(spark, d):
    train, vocabs = hetero_graph(spark, d)
    return g.node_ids(vocabs, HETERO_KEYS, train)


@query("g04_node_features", f"""
    WITH c AS (SELECT card1, card2, card4, avg(TransactionAmt) AS am, count(TransactionAmt) AS ac, avg(isFraud) AS fr, sum(isFraud) AS fc FROM htrain GROUP BY 1, 2, 3),
         e AS (SELECT P_emaildomain, avg(TransactionAmt) AS am, count(TransactionAmt) AS ac, avg(isFraud) AS fr FROM htrain GROUP BY 1),
         v AS (SELECT DeviceType, DeviceInfo_simple, avg(TransactionAmt) AS am, count(TransactionAmt) AS ac, avg(isFraud) AS fr FROM htrain GROUP BY 1, 2)
    SELECT node_id, 'card' AS ntype, 64 AS dim, {steady_sql("coalesce(am, 0)", 4)} AS f0, ac::DOUBLE AS f1, round(fr, 6) AS f2, fc::DOUBLE AS f3,
           0.0::DOUBLE AS f4, 0.0::DOUBLE AS f5, 0.0::DOUBLE AS f6, 0.0::DOUBLE AS f7, 0.0::DOUBLE AS f9 FROM hcards JOIN c USING (card1, card2, card4)
    UNION ALL SELECT node_id, 'email', 64, 0, 0, 0, 0, {steady_sql("coalesce(am, 0)", 4)}, ac, round(fr, 6), 0, 0 FROM hemails JOIN e USING (P_emaildomain)
    UNION ALL SELECT node_id, 'device', 64, 0, 0, 0, 0, 0, 0, 0, {steady_sql("coalesce(am, 0)", 4)}, round(fr, 6) FROM hdevices JOIN v USING (DeviceType, DeviceInfo_simple)
    UNION ALL SELECT start + row_id, 'txn', 64, {steady_sql("coalesce(TransactionAmt, 0)", 4)}, TransactionDT, C1, 0, 0, 0, 0, {steady_sql("coalesce(D1, 0)", 4)}, 0 FROM htrain, hstart""")
def g04(spark, d):
    train, vocabs = hetero_graph(spark, d)
    stats = {
        n: entity_stats(train, keys, stats=CARD_STATS if n == "card" else PAIR_STATS) for n, keys in HETERO_KEYS.items()
    }
    rows = g.node_features(train, vocabs, stats, HETERO_KEYS)
    plain, amounts = {1: 4, 2: 6, 3: 4, 5: 4, 6: 6, 9: 6}, (0, 4, 7)
    return rows.select(
        "node_id", "ntype", F.size("feat").alias("dim"),
        *[F.round(F.col("feat")[i], n).alias(f"f{i}") for i, n in plain.items()],
        *[steady(F.col("feat")[i], 4).alias(f"f{i}") for i in amounts],
    )


@query("g05_propagate", f"""
    WITH h1 AS ({hop_sql('nfeat')}) SELECT node_id, {steady_sql("x0", 6)} AS x0, {steady_sql("x1", 6)} AS x1 FROM h1""")
def g05(spark, d):
    *_, nodes, edges = small_graph(spark, d)
    out = g.propagate(nodes, edges, 2)
    return out.select("node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


@query("g05_propagate_spread", f"""
    WITH h1 AS ({hop_sql('nfeat')}) SELECT node_id, {steady_sql("x0", 6)} AS x0, {steady_sql("x1", 6)} AS x1 FROM h1""")
def g05_spread(spark, d):
    """The way a graph beyond broadcast size goes: shuffled lookup with hub rows spread over salts."""
    *_, nodes, edges = small_graph(spark, d)
    out = g.propagate(nodes, edges, 2, broadcast_bytes=0)
    return out.select("node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


@query("g06_propagate_k", f"""
    WITH h1 AS ({hop_sql('nfeat')}), h2 AS ({hop_sql('h1')}), h3 AS ({hop_sql('h2')})
    SELECT nfeat.node_id, {steady_sql("nfeat.x0", 6)} AS h0, {steady_sql("h1.x0", 6)} AS h1, {steady_sql("h2.x0", 6)} AS h2, {steady_sql("h3.x0", 6)} AS h3
    FROM nfeat JOIN h1 USING (node_id) JOIN h2 USING (node_id) JOIN h3 USING (node_id)""")
def g06(spark, d):
    *_, nodes, edges = small_graph(spark, d)
    out = g.propagate_k(nodes, edges, 2, hops=3)
    return out.select("node_id", *[steady(F.col("feat")[2 * i], 6).alias(f"h{i}") for i in range(4)])


def small_bucketed(spark, d):
    """The small graph with its edges bucketed by transaction."""
    _, cards, emails, nodes, edges = small_graph(spark, d)
    return nodes, BucketedGraph.write(nodes, edges, g.node_offsets(g.vocab_sizes({"card": cards, "email": emails}))["txn"])


@query("g05_propagate_bucketed", f"""
    WITH h1 AS ({hop_sql('nfeat')}) SELECT node_id, {steady_sql("x0", 6)} AS x0, {steady_sql("x1", 6)} AS x1 FROM h1""")
def g05_bucketed(spark, d):
    """One hop over edges that are bucketed by transaction: none of them is exchanged."""
    nodes, graph = small_bucketed(spark, d)
    txn, entities = graph.hop(*graph.place(nodes), 2)
    return txn.unionByName(entities).select("node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


@query("g06_propagate_k_bucketed", f"""
    WITH h1 AS ({hop_sql('nfeat')}), h2 AS ({hop_sql('h1')}), h3 AS ({hop_sql('h2')})
    SELECT nfeat.node_id, {steady_sql("nfeat.x0", 6)} AS h0, {steady_sql("h1.x0", 6)} AS h1, {steady_sql("h2.x0", 6)} AS h2, {steady_sql("h3.x0", 6)} AS h3
    FROM nfeat JOIN h1 USING (node_id) JOIN h2 USING (node_id) JOIN h3 USING (node_id)""")
def g06_bucketed(spark, d):
    nodes, graph = small_bucketed(spark, d)
    out = graph.propagate_k(nodes, 2, 3)
    return out.select("node_id", *[steady(F.col("feat")[2 * i], 6).alias(f"h{i}") for i in range(4)])


_SAMPLED = """
    sampled AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY md5(src || '|' || dst || '|42'), src) AS rn
                FROM edges) WHERE rn <= 32)"""


@query("g07_sample_neighbors", f"WITH {_SAMPLED} SELECT src, dst FROM sampled")
def g07(spark, d):
    *_, edges = small_graph(spark, d)
    return g.sample_neighbors(edges, 32)


@query("g07_sage_mean", f"""
    WITH {_SAMPLED}, a AS (SELECT dst, avg(x0) AS x0, avg(x1) AS x1 FROM sampled JOIN nfeat ON nfeat.node_id = sampled.src GROUP BY dst)
    SELECT node_id, {steady_sql("coalesce(a.x0, 0)", 6)} AS x0, {steady_sql("coalesce(a.x1, 0)", 6)} AS x1 FROM nfeat LEFT JOIN a ON a.dst = nfeat.node_id""")
def g07_mean(spark, d):
    *_, nodes, edges = small_graph(spark, d)
    out = g.sage_mean(nodes, g.sample_neighbors(edges, 32), 2)
    return out.select("node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


@query("g07_sage_hops", f"""
    WITH s1 AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY md5(src || '|' || dst || '|42'), src) AS rn FROM edges) WHERE rn <= 32),
         s2 AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY md5(src || '|' || dst || '|43'), src) AS rn FROM edges) WHERE rn <= 32),
         a AS (SELECT node_id, coalesce(m.x0, 0) AS x0, coalesce(m.x1, 0) AS x1 FROM nfeat LEFT JOIN (
                 SELECT dst, avg(x0) AS x0, avg(x1) AS x1 FROM s1 JOIN nfeat ON nfeat.node_id = s1.src GROUP BY dst) m ON m.dst = nfeat.node_id),
         c AS (SELECT dst, avg(x0) AS x0, avg(x1) AS x1 FROM s2 JOIN a ON a.node_id = s2.src GROUP BY dst)
    SELECT node_id, {steady_sql("coalesce(c.x0, 0)", 6)} AS x0, {steady_sql("coalesce(c.x1, 0)", 6)} AS x1 FROM nfeat LEFT JOIN c ON c.dst = nfeat.node_id""")
def g07_hops(spark, d):
    """Two hops of sampled means, each with a sample of its own."""
    *_, nodes, edges = small_graph(spark, d)
    out = g.sage_hops(nodes, edges, 2)
    return out.select("node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


# Mini-batches of the positive transactions: seeds, two hops of sampled edges, ids per batch
VIEWS["seeds"] = """
    SELECT (row_number() OVER (ORDER BY md5(node_id || '|42'), node_id) - 1) // 256 AS batch, node_id
    FROM (SELECT n_cards + n_emails + row_id AS node_id FROM train, sizes WHERE isFraud = 1)"""
for _hop, _fan in ((1, 32), (2, 32)):
    VIEWS[f"fan_{_hop}"] = f"""
    SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY md5(src || '|' || dst || '|{41 + _hop}'), src) AS rn FROM edges)
    WHERE rn <= {_fan}"""
VIEWS["block_1"] = "SELECT batch, 1 AS hop, src, dst FROM seeds JOIN fan_1 ON dst = node_id"
VIEWS["block_2"] = "SELECT batch, 2 AS hop, fan_2.src, fan_2.dst FROM (SELECT DISTINCT batch, src AS node_id FROM block_1) f JOIN fan_2 ON dst = node_id"
VIEWS["block_nodes"] = """
    SELECT batch, node_id, min(hop) AS hop, row_number() OVER (PARTITION BY batch ORDER BY min(hop), node_id) - 1 AS local_id FROM (
      SELECT batch, node_id, 0 AS hop FROM seeds UNION ALL SELECT batch, src, 1 FROM block_1 UNION ALL SELECT batch, src, 2 FROM block_2)
    GROUP BY batch, node_id"""


def seed_nodes(train, cards, emails):
    start = g.node_offsets(g.vocab_sizes({"card": cards, "email": emails}))["txn"]
    return train.filter("isFraud = 1").select((F.col("row_id") + start).alias("node_id"))


@query("g07_two_hop_blocks", """
    WITH b AS (SELECT * FROM block_1 UNION ALL SELECT * FROM block_2)
    SELECT b.batch, b.hop, b.src, b.dst, s.local_id AS src_id, t.local_id AS dst_id
    FROM b JOIN block_nodes s ON s.batch = b.batch AND s.node_id = b.src JOIN block_nodes t ON t.batch = b.batch AND t.node_id = b.dst""")
def g07_blocks(spark, d):
    """Two hops, fan-out 32 each, batches of 256 seeds."""
    train, cards, emails, _, edges = small_graph(spark, d)
    blocks, _ = sampled_blocks(edges, seed_nodes(train, cards, emails), (32, 32), 256)
    return blocks.select("batch", "hop", "src", "dst", F.col("src_id").cast("long").alias("src_id"), F.col("dst_id").cast("long").alias("dst_id"))


@query("g07_block_mean", f"""
    WITH m2 AS (SELECT batch, dst, avg(x0) AS x0, avg(x1) AS x1 FROM block_2 JOIN nfeat ON nfeat.node_id = src GROUP BY batch, dst),
         m1 AS (SELECT block_1.batch, block_1.dst, avg(coalesce(m2.x0, 0)) AS x0, avg(coalesce(m2.x1, 0)) AS x1
                FROM block_1 LEFT JOIN m2 ON m2.batch = block_1.batch AND m2.dst = block_1.src GROUP BY block_1.batch, block_1.dst)
    SELECT seeds.batch, node_id, {steady_sql("coalesce(m1.x0, 0)", 6)} AS x0, {steady_sql("coalesce(m1.x1, 0)", 6)} AS x1
    FROM seeds LEFT JOIN m1 ON m1.batch = seeds.batch AND m1.dst = node_id""")
def g07_block_mean(spark, d):
    """Means along the blocks, from the outermost hop inwards."""
    train, cards, emails, nodes, edges = small_graph(spark, d)
    blocks, local = sampled_blocks(edges, seed_nodes(train, cards, emails), (32, 32), 256)
    seeds = local.filter("hop = 0").select("batch", "node_id")
    out = block_mean(nodes, settle(blocks, "blocks"), seeds, 2)
    return out.select("batch", "node_id", *[steady(F.col("feat")[i], 6).alias(f"x{i}") for i in range(2)])


@query("g08_txn_features", """
    WITH dev AS (SELECT DeviceType, DeviceInfo_simple, CAST(embedding[33:64] AS DOUBLE[]) AS emb FROM (
                   SELECT *, node_id - (SELECT min(node_id) FROM hdevices) AS i FROM hdevices) JOIN embeddings ON vec_id = i),
         r AS (SELECT split.*, coalesce(DeviceType, 'unknown') AS DeviceType,
                      coalesce(split_part(lower(DeviceInfo), '/', 1), 'unknown') AS DeviceInfo_simple FROM split LEFT JOIN idn USING (TransactionID))
    SELECT TransactionID, 81 AS n, coalesce(TransactionAmt, 0) AS amt, TransactionDT::DOUBLE AS dt, C1::DOUBLE AS c1, coalesce(D1, 0) AS d1,
           round(coalesce(list_sum(card_emb.emb), 0), 6) AS card_part, round(coalesce(list_sum(dev.emb), 0), 6) AS device_part
    FROM r LEFT JOIN card_emb USING (card1) LEFT JOIN dev USING (DeviceType, DeviceInfo_simple)""")
def g08(spark, d):
    rows = split_txn(spark, d, "TransactionAmt", "C1", "D1", "card1", "P_emaildomain")
    full = fill_categorical(
        add_simple_device(merge_identity(rows, b.idn(spark, d))), ["P_emaildomain", "DeviceType", "DeviceInfo_simple"], "unknown"
    )
    full = settle(full, "rows")
    train = full.filter("split = 'train'")
    devices = first_seen_vocab(train, HETERO_KEYS["device"], ORDER)
    vecs = b.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("idx"), F.slice(F.col("embedding").cast("array<double>"), 33, 32).alias("emb")
    )
    device_emb = settle(devices.join(vecs, "idx").select(*HETERO_KEYS["device"], "emb"), "embedding")
    out = g.txn_features(full, b.card_embedding(spark, d), device_emb, ["card1"], HETERO_KEYS["device"])
    part = lambda at: F.aggregate(F.slice("features", at, 32), F.lit(0.0), lambda acc, x: acc + x)
    f = F.col("features")
    return out.select(
        "TransactionID", F.size(f).alias("n"), f[0].alias("amt"), f[1].alias("dt"), f[2].alias("c1"), f[7].alias("d1"),
        F.round(part(18), 6).alias("card_part"), F.round(part(50), 6).alias("device_part"),
    )


@query("g10_cooccurrence", """
    SELECT card1, DeviceType, count(*) AS n FROM merged WHERE DeviceType IS NOT NULL GROUP BY 1, 2""")
def g10(spark, d):
    return g.cooccurrence(merge_identity(b.txn(spark, d), b.idn(spark, d)), ["card1"], ["DeviceType"])


@query("g11_test_graph", """
    WITH kept AS (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS row_id FROM test
                  WHERE card1 IN (SELECT card1 FROM cards) AND P_emaildomain IN (SELECT P_emaildomain FROM emails)),
         ends AS (SELECT cards.idx AS c, n_cards + emails.idx AS e, n_cards + n_emails + row_id AS t
                  FROM kept JOIN cards USING (card1) JOIN emails USING (P_emaildomain), sizes)
    SELECT unnest([c, t, t, e]) AS src, unnest([t, e, c, t]) AS dst FROM ends""")
def g11(spark, d):
    rows = split_txn(spark, d, "card1", "P_emaildomain")
    cards, emails = card_email_vocabs(named_email(rows.filter("split = 'train'")))
    return g.build_test_graph(named_email(rows.filter("split = 'test'")), cards, emails, ORDER)[1]


@query("g12_node_labels", "SELECT n_cards + n_emails + row_id AS node_id, isFraud FROM train, sizes")
def g12(spark, d):
    train = numbered_train(spark, d, "isFraud")
    cards, emails = card_email_vocabs(train)
    vocabs, keys = {"card": cards, "email": emails}, {"card": ["card1"], "email": ["P_emaildomain"]}
    nodes = g.node_ids(vocabs, keys, train)
    return g.node_labels(nodes, train, "isFraud", g.node_offsets(g.vocab_sizes(vocabs))["txn"])


@query("g12_offsets", "SELECT min(n_cards + n_emails + row_id) AS start, max(n_cards + n_emails + row_id) + 1 AS \"end\" FROM train, sizes")
def g12_offsets(spark, d):
    train = numbered_train(spark, d)
    cards, emails = card_email_vocabs(train)
    keys = {"card": ["card1"], "email": ["P_emaildomain"]}
    return g.offsets(g.node_ids({"card": cards, "email": emails}, keys, train))


@query("a21_graph_summary", """
    SELECT 'card' AS kind, count(*) AS n FROM cards UNION ALL SELECT 'email', count(*) FROM emails
    UNION ALL SELECT 'txn', count(*) FROM train UNION ALL SELECT 'edges', count(*) FROM edges""")
def a21(spark, d):
    train = numbered_train(spark, d)
    cards, emails = card_email_vocabs(train)
    nodes = g.node_ids({"card": cards, "email": emails}, {"card": ["card1"], "email": ["P_emaildomain"]}, train)
    return g.graph_summary(nodes, g.build_edges_card_email(train, cards, emails))


@query("a22_degrees", """
    SELECT node_id, coalesce(ideg.d, 0) AS in_degree, coalesce(odeg.d, 0) AS out_degree
    FROM nfeat LEFT JOIN ideg ON ideg.dst = node_id LEFT JOIN odeg ON odeg.src = node_id""")
def a22(spark, d):
    *_, nodes, edges = small_graph(spark, d)
    return g.degrees(nodes, edges)
