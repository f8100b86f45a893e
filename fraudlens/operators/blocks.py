"""Sampled neighbourhoods of mini-batches, as one table of blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fraudlens.functions.vectors import or_zeros, spread
from fraudlens.operators.graph import sample_neighbors
from fraudlens.operators.joins import lookup
from fraudlens.operators.ordering import global_row_id
from fraudlens.session import settle

# The published sampling parameters.
FAN_OUTS = (32, 32)
BATCH_SIZE = 1024


def seed_batches(seeds: DataFrame, batch_size: int = BATCH_SIZE, seed: int = 42) -> DataFrame:
    """``(batch, node_id)``: seed nodes dealt into batches of ``batch_size`` in the order of md5 of (node, seed)."""
    draw = F.md5(F.concat_ws("|", F.col("node_id").cast("string"), F.lit(str(seed))))
    placed = global_row_id(seeds.select("node_id", draw.alias("_draw")), ["_draw", "node_id"], "_at")
    return placed.select(F.floor(F.col("_at") / batch_size).cast("long").alias("batch"), "node_id")


def sampled_blocks(
    edges: DataFrame, seeds: DataFrame, fan_outs: Sequence[int] = FAN_OUTS, batch_size: int = BATCH_SIZE, seed: int = 42, **tuning
) -> tuple[DataFrame, DataFrame]:
    """``(batch, hop, src, dst, src_id, dst_id)`` and ``(batch, node_id, hop, local_id)``.

    Hop 1 brings the sampled neighbours of a batch's seeds, each next hop those of the nodes the hop
    before has found, at most ``fan_outs[hop - 1]`` each. A node's sample of one hop is the same in all
    batches, so a hub is sampled once, with map-side cuts, and comes once into a batch. ``local_id`` counts a batch's
    nodes from 0, by the hop that finds them first (0 for seeds) and then by id: ids without gaps for
    the batch's own arrays. A batch has at most ``batch_size`` times the fan-outs' product of nodes.
    """
    frontier = settle(seed_batches(seeds, batch_size, seed), "frontier")
    parts, found = [], [frontier.withColumn("hop", F.lit(0))]
    for hop, fan_out in enumerate(fan_outs, start=1):
        wanted = edges.join(frontier.select(F.col("node_id").alias("dst")).distinct(), "dst", "left_semi")
        sampled = settle(sample_neighbors(wanted, fan_out, seed + hop - 1), "sampled")
        reached = frontier.withColumnRenamed("node_id", "dst").join(sampled.hint("merge"), "dst")
        part = settle(reached.select("batch", F.lit(hop).alias("hop"), "src", "dst"), "block")
        frontier = settle(part.select("batch", F.col("src").alias("node_id")).distinct(), "frontier")
        parts.append(part)
        found.append(frontier.withColumn("hop", F.lit(hop)))
    blocks, nodes = parts[0], found[0]
    for part in parts[1:]:
        blocks = blocks.unionByName(part)
    for part in found[1:]:
        nodes = nodes.unionByName(part)
    first = nodes.groupBy("batch", "node_id").agg(F.min("hop").alias("hop"))
    order = Window.partitionBy("batch").orderBy("hop", "node_id")  # a batch, never a hub or the whole graph
    local = settle(first.withColumn("local_id", F.row_number().over(order) - 1), "nodes")
    for end in ("src", "dst"):
        name = local.select("batch", F.col("node_id").alias(end), F.col("local_id").alias(f"{end}_id"))
        blocks = blocks.join(name, ["batch", end])
    return blocks.select("batch", "hop", "src", "dst", "src_id", "dst_id"), local


def block_mean(nodes: DataFrame, blocks: DataFrame, seeds: DataFrame, dim: int, feat: str = "feat", **tuning) -> DataFrame:
    """``(batch, node_id, feat)`` of the seeds ``(batch, node_id)``: the mean over a seed's sampled neighbours
    of the means over theirs, from the outermost hop inwards, as a block is used layer by layer."""
    hops = sorted(r["hop"] for r in blocks.select("hop").distinct().collect())  # as many as fan-outs
    vectors = nodes.select(F.col("node_id").alias("src"), F.col(feat).alias("_msg"))
    here: DataFrame | None = None
    dims = [f"h{i}" for i in range(dim)]
    for hop in reversed(hops):
        part = blocks.filter(F.col("hop") == hop).select("batch", "src", "dst")
        sent = lookup(part, settle(vectors, "vectors"), "src", "left", **tuning) if here is None else part.join(here, ["batch", "src"], "left")
        sent = sent.withColumn("_msg", or_zeros(F.col("_msg"), dim))
        mean = sent.select("batch", "dst", *spread(F.col("_msg"), dim)).groupBy("batch", "dst").agg(*[F.avg(h).alias(h) for h in dims])
        here = settle(mean.select("batch", F.col("dst").alias("src"), F.array(*dims).alias("_msg")), "means")
    out = seeds.join(here.withColumnRenamed("src", "node_id"), ["batch", "node_id"], "left")
    return out.select("batch", "node_id", or_zeros(F.col("_msg"), dim).alias(feat))
