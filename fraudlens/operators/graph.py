"""Transaction-entity graphs: nodes, edges, features, propagation by joins and sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudlens.functions.scalars import UNKNOWN, zero_default
from fraudlens.functions.vectors import first_dims, or_zeros, padded, spread, squared_error, zeros
from fraudlens.operators.entity import CARD_STATS, PAIR_STATS
from fraudlens.operators.joins import filter_unseen, lookup
from fraudlens.operators.ordering import global_row_id
from fraudlens.schema import NODE_FEATURES
from fraudlens.session import settle

# Width of a node vector and the first slot of each entity kind's statistics.
NODE_DIM = 64
CARD_SLOT, EMAIL_SLOT, DEVICE_SLOT = 0, 4, 7


def vocab_sizes(vocabs: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of each written vocabulary (answered from file footers)."""
    return {name: v.count() for name, v in vocabs.items()}


def node_offsets(sizes: dict[str, int]) -> dict[str, int]:
    """First node id of each entity type in the given order; ``txn`` comes last."""
    out, at = {}, 0
    for name, size in sizes.items():
        out[name] = at
        at += size
    return {**out, "txn": at}


def node_ids(vocabs: dict[str, DataFrame], keys: dict[str, Sequence[str]], tx: DataFrame, row_id: str = "row_id", idx: str = "idx") -> DataFrame:
    """(node_id, ntype, key): entity types in order, then transactions, in one id range each."""
    offsets = node_offsets(vocab_sizes(vocabs))
    parts = [
        v.select(
            (F.col(idx) + offsets[name]).alias("node_id"),
            F.lit(name).alias("ntype"),
            F.concat_ws("_", *[F.coalesce(F.col(k).cast("string"), F.lit("unknown")) for k in keys[name]]).alias("key"),
        )
        for name, v in vocabs.items()
    ]
    parts.append(
        tx.select(
            (F.col(row_id) + offsets["txn"]).alias("node_id"),
            F.lit("txn").alias("ntype"),
            F.col(row_id).cast("string").alias("key"),
        )
    )
    return union_nodes(parts)


def union_nodes(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_edges(parts: Sequence[DataFrame]) -> DataFrame:
    return union_nodes(parts)


def _directed(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return F.explode(F.array(*[F.struct(a.alias("src"), b.alias("dst")) for a, b in pairs]))


def build_edges_card_email(
    tx: DataFrame,
    cards: DataFrame,
    emails: DataFrame,
    card: str = "card1",
    email: str = "P_emaildomain",
    row_id: str = "row_id",
    **tuning,
) -> DataFrame:
    """Four directed edges per transaction: card->tx, tx->email, tx->card, email->tx.

    Two lookups and one explode; transactions with an unknown entity have no edges. A missing key is an
    entity of its own, if the vocabulary has it.
    """
    offsets = node_offsets(vocab_sizes({"card": cards, "email": emails}))
    narrow = tx.select(row_id, card, email)
    named = lookup(narrow, cards.select(card, F.col("idx").alias("_c")), card, "inner", null_safe=True, **tuning)
    named = lookup(named, emails.select(email, F.col("idx").alias("_e")), email, "inner", null_safe=True, **tuning)
    c, e = F.col("_c") + offsets["card"], F.col("_e") + offsets["email"]
    t = F.col(row_id) + offsets["txn"]
    return named.select(_directed([(c, t), (t, e), (t, c), (e, t)]).alias("_edge")).select("_edge.src", "_edge.dst")


def build_edges_hetero(
    tx: DataFrame,
    vocabs: dict[str, DataFrame],
    keys: dict[str, Sequence[str]],
    amount: str = "TransactionAmt",
    time: str = "TransactionDT",
    row_id: str = "row_id",
    **tuning,
) -> DataFrame:
    """tx<->entity edges for each entity that resolves, with [amount, time] on both directions."""
    offsets = node_offsets(vocab_sizes(vocabs))
    used = list(dict.fromkeys(k for cols in keys.values() for k in cols))
    named = tx.select(row_id, *dict.fromkeys([amount, time, *used]))
    for name, vocab in vocabs.items():
        part = vocab.select(*keys[name], (F.col("idx") + offsets[name]).alias(f"_{name}"))
        named = lookup(named, part, list(keys[name]), "left", null_safe=True, **tuning)
    t = F.col(row_id) + offsets["txn"]
    feat = F.array(zero_default(F.col(amount)), zero_default(F.col(time)))
    ends = F.array(
        *[
            F.struct(F.lit(name).alias("etype"), F.col(f"_{name}").alias("entity"))
            for name in vocabs
        ]
    )
    pairs = named.select(t.alias("_t"), feat.alias("feat"), F.explode(ends).alias("_end")).filter("_end.entity is not null")
    both = F.explode(
        F.array(
            F.struct(F.col("_t").alias("src"), F.col("_end.entity").alias("dst")),
            F.struct(F.col("_end.entity").alias("src"), F.col("_t").alias("dst")),
        )
    )
    return pairs.select(both.alias("_edge"), F.col("_end.etype").alias("etype"), "feat").select(
        "_edge.src", "_edge.dst", "etype", "feat"
    )


def build_test_graph(
    test: DataFrame, cards: DataFrame, emails: DataFrame, order: Sequence[str], card: str = "card1", email: str = "P_emaildomain", **tuning
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept rows with new row ids, edges, before/after report) of test rows on the training vocabulary."""
    kept, report = filter_unseen(test, {card: cards, email: emails}, **tuning)
    numbered = global_row_id(kept, order, "row_id")
    return numbered, build_edges_card_email(numbered, cards, emails, card, email, **tuning), report


def entity_nodes(
    vocabs: dict[str, DataFrame], stats: dict[str, DataFrame], keys: dict[str, Sequence[str]], dim: int = NODE_DIM
) -> list[DataFrame]:
    """Per entity type (node_id, ntype, feat): its statistics in the type's slots, zeros elsewhere."""
    slots = {"card": (CARD_SLOT, CARD_STATS), "email": (EMAIL_SLOT, PAIR_STATS), "device": (DEVICE_SLOT, PAIR_STATS)}
    offsets = node_offsets(vocab_sizes(vocabs))
    out = []
    for name, vocab in vocabs.items():
        start, names = slots[name]
        # vocabulary and profile have the same keys: one co-partitioned join, no lookup table to broadcast
        profile = stats[name].withColumnsRenamed({k: f"_{k}" for k in keys[name]})
        same = F.lit(True)
        for k in keys[name]:
            text = vocab.schema[k].dataType.typeName() == "string"
            same = same & (F.coalesce(k, F.lit(UNKNOWN)) if text else F.col(k)).eqNullSafe(F.col(f"_{k}"))
        joined = vocab.join(profile, same, "left").na.fill(0, subset=list(names))
        out.append(
            joined.select(
                (F.col("idx") + offsets[name]).alias("node_id"),
                F.lit(name).alias("ntype"),
                padded([F.col(s) for s in names], start, dim).alias("feat"),
            )
        )
    return out


def node_features(
    tx: DataFrame,
    vocabs: dict[str, DataFrame],
    stats: dict[str, DataFrame],
    keys: dict[str, Sequence[str]],
    features: Sequence[str] = NODE_FEATURES,
    row_id: str = "row_id",
    dim: int = NODE_DIM,
) -> DataFrame:
    """(node_id, ntype, feat) of all nodes; a transaction carries its raw features from slot 0 (0 where absent)."""
    offsets = node_offsets(vocab_sizes(vocabs))
    raw = [zero_default(F.col(c)) if c in tx.columns else F.lit(0.0) for c in features]
    txn = tx.select(
        (F.col(row_id) + offsets["txn"]).alias("node_id"), F.lit("txn").alias("ntype"), padded(raw, 0, dim).alias("feat")
    )
    return union_nodes([*entity_nodes(vocabs, stats, keys, dim), txn])


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes per type and number of edges, as (kind, n)."""
    by_type = nodes.groupBy(F.col("ntype").alias("kind")).agg(F.count("*").alias("n"))
    return by_type.unionByName(edges.agg(F.count("*").alias("n")).select(F.lit("edges").alias("kind"), "n"))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_id, in_degree, out_degree), zero for isolated nodes.

    Both degrees come from one aggregation of edge ends, so hubs are combined map-side.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("node_id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
            F.struct(F.col("dst").alias("node_id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
        )
    )
    counts = (
        edges.select(ends.alias("_e")).select("_e.*").groupBy("node_id")
        .agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    )
    return nodes.select("node_id").join(counts, "node_id", "left").na.fill(0)


def propagate(nodes: DataFrame, edges: DataFrame, dim: int, feat: str = "feat", **tuning) -> DataFrame:
    """One weight-free symmetric-normalised graph convolution.

    h'(v) = sum over edges u->v of h(u)/sqrt(out(u)*in(v)); a node without incoming edges becomes zero.
    A hub is harmless on both sides: as a source its rows are spread by the lookup, as a target its
    messages are summed in each task before the shuffle. Sums are per dimension, in plain hash
    aggregation, and the in-degree falls out of the same aggregation.
    """
    out_deg = edges.groupBy("src").agg(F.count("*").alias("_out"))
    scale = F.sqrt(F.greatest(F.col("_out"), F.lit(1)).cast("double"))
    sources = settle(
        nodes.join(out_deg.withColumnRenamed("src", "node_id"), "node_id", "inner").select(
            F.col("node_id").alias("src"), F.transform(feat, lambda x: x / scale).alias("_msg")
        ),
        "messages",
    )
    sent = lookup(edges.select("src", "dst"), sources, "src", "inner", **tuning)
    dims = [f"h{i}" for i in range(dim)]
    summed = sent.select("dst", *spread(F.col("_msg"), dim)).groupBy("dst").agg(
        F.count("*").alias("_in"), *[F.sum(h).alias(h) for h in dims]
    )
    root = F.sqrt(F.col("_in").cast("double"))
    landed = summed.select(F.col("dst").alias("node_id"), F.array(*[F.col(h) / root for h in dims]).alias("_new"))
    kept = [c for c in nodes.columns if c != feat]
    return nodes.select(*kept).join(landed, "node_id", "left").select(*kept, or_zeros(F.col("_new"), dim).alias(feat))


def propagate_k(nodes: DataFrame, edges: DataFrame, dim: int, hops: int = 3, feat: str = "feat", **tuning) -> DataFrame:
    """Node vectors [X, AX, A^2 X, ...] side by side, (hops+1)*dim wide; every hop is written before the next."""
    here = settle(nodes, "hop")
    stacked = here
    for hop in range(1, hops + 1):
        here = settle(propagate(here, edges, dim, feat, **tuning), "hop")
        add = here.select("node_id", F.col(feat).alias(f"_hop{hop}"))
        stacked = stacked.join(add, "node_id").withColumn(feat, F.concat(feat, f"_hop{hop}")).drop(f"_hop{hop}")
    return stacked


def sample_neighbors(edges: DataFrame, fan_out: int = 32, seed: int = 42) -> DataFrame:
    """At most ``fan_out`` incoming edges per node, chosen by the smallest md5 of (src, dst, seed).

    Spark keeps only the best ``fan_out`` edges of a node in each task before the shuffle, so a hub
    brings at most tasks * fan_out rows together.
    """
    draw = F.md5(F.concat_ws("|", F.col("src").cast("string"), F.col("dst").cast("string"), F.lit(str(seed))))
    order = Window.partitionBy("dst").orderBy("_draw", "src")
    return (
        edges.select("src", "dst").withColumn("_draw", draw)
        .withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= fan_out)
        .select("src", "dst")
    )


def sage_mean(nodes: DataFrame, sampled: DataFrame, dim: int, feat: str = "feat", **tuning) -> DataFrame:
    """Mean feature vector of each node's sampled neighbours, zero without neighbours."""
    sources = settle(nodes.select(F.col("node_id").alias("src"), F.col(feat).alias("_msg")), "messages")
    sent = lookup(sampled, sources, "src", "inner", **tuning)
    dims = [f"h{i}" for i in range(dim)]
    mean = sent.select("dst", *spread(F.col("_msg"), dim)).groupBy("dst").agg(*[F.avg(h).alias(h) for h in dims])
    landed = mean.select(F.col("dst").alias("node_id"), F.array(*dims).alias("_mean"))
    kept = [c for c in nodes.columns if c != feat]
    return nodes.select(*kept).join(landed, "node_id", "left").select(*kept, or_zeros(F.col("_mean"), dim).alias(feat))


def sage_hops(nodes: DataFrame, edges: DataFrame, dim: int, fan_outs: Sequence[int] = (32, 32), seed: int = 42, feat: str = "feat", **tuning) -> DataFrame:
    """Sampled mean aggregation over several hops, one fresh sample per hop."""
    here = nodes
    for hop, fan_out in enumerate(fan_outs):
        here = settle(sage_mean(here, sample_neighbors(edges, fan_out, seed + hop), dim, feat, **tuning), "hop")
    return here


def node_labels(nodes: DataFrame, tx: DataFrame, label: str, offset: int, row_id: str = "row_id") -> DataFrame:
    """(node_id, label) of the transaction nodes."""
    known = tx.select((F.col(row_id) + offset).alias("node_id"), label)
    return nodes.filter(F.col("ntype") == "txn").select("node_id").join(known, "node_id")


def offsets(nodes: DataFrame) -> DataFrame:
    """Id range [start, end) of the transaction nodes."""
    return nodes.filter(F.col("ntype") == "txn").agg(
        F.min("node_id").alias("start"), (F.max("node_id") + 1).alias("end")
    )


def cooccurrence(df: DataFrame, a: Sequence[str], b: Sequence[str]) -> DataFrame:
    """Entity pairs seen in the same transaction, with their number of transactions."""
    return df.na.drop(subset=[*a, *b]).groupBy(*a, *b).agg(F.count("*").alias("n"))


def reconstruction_mse(nodes: DataFrame, vec: str, feat: str, d: int) -> DataFrame:
    """Mean squared difference between a d-wide embedding and the first d input features."""
    err = squared_error(F.col(vec), first_dims(F.col(feat), d))
    return nodes.agg((F.avg(err) / d).alias("reconstruction_mse"))


def txn_features(
    df: DataFrame,
    card_emb: DataFrame,
    device_emb: DataFrame | None,
    card_keys: Sequence[str],
    device_keys: Sequence[str] = (),
    dim: int = 32,
    features: Sequence[str] = NODE_FEATURES,
    **tuning,
) -> DataFrame:
    """Add ``features``: raw values, then card embedding, then device embedding (zeros when unseen).

    A missing key part is a value like any other: it finds the entity that was made of it.
    """
    raw = F.array(*[zero_default(F.col(c)) if c in df.columns else F.lit(0.0) for c in features])
    out = lookup(df, card_emb.withColumnRenamed("emb", "_card_emb"), list(card_keys), "left", null_safe=True, **tuning)
    device = zeros(dim)
    if device_emb is not None:
        out = lookup(out, device_emb.withColumnRenamed("emb", "_device_emb"), list(device_keys), "left", null_safe=True, **tuning)
        device = or_zeros(F.col("_device_emb"), dim)
    built = F.concat(raw, or_zeros(F.col("_card_emb"), dim), device)
    return out.withColumn("features", built).drop("_card_emb", "_device_emb")


