"""Propagation over edges that are written once, bucketed by their transaction end.

A transaction graph has two kinds of edges, from entities to transactions and back. Both are bucketed by the
transaction, as are the transactions' vectors: a hop then joins and sums transactions where they lie, and
only the entities' sums, combined in every task before, are exchanged. Entities' vectors are broadcast
when their measured size allows, else the edges from entities are joined by a shuffled lookup.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens.functions.vectors import or_zeros, spread
from fraudlens.operators.joins import BROADCAST_BYTES, lookup, measured_bytes
from fraudlens.session import settle, workspace


def write_bucketed(df: DataFrame, by: str, buckets: int, label: str) -> DataFrame:
    """``df`` in ``buckets`` files of rows that are equal in ``by`` modulo hashing, sorted by it, below the shared folder.

    Rows are placed for their bucket before they are written, so a task writes one file.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, by)
    placed.write.bucketBy(buckets, by).sortBy(by).option("path", workspace(spark, label)).format("parquet").saveAsTable(name)
    return spark.table(name)


@dataclass
class BucketedGraph:
    """Edges of both directions by transaction, with the scale of every edge, and all entities."""

    spark: SparkSession
    inward: DataFrame  # entity -> transaction: (src, dst, scale), bucketed by dst
    outward: DataFrame  # transaction -> entity: (src, dst, scale), bucketed by src
    txn: DataFrame  # (node_id) of transactions, bucketed by it
    entities: DataFrame  # (node_id)
    buckets: int

    @classmethod
    def write(cls, nodes: DataFrame, edges: DataFrame, first_txn: int, buckets: int | None = None) -> BucketedGraph:
        """``nodes`` (node_id) and ``edges`` (src, dst) of a graph whose transactions have ids from ``first_txn`` on.

        Degrees are counted once: an edge carries 1 / sqrt(out-degree of its source * in-degree of its
        target). Edges between entities are refused; there are none in these graphs.
        """
        spark = edges.sparkSession
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        outs = settle(edges.groupBy("src").agg(F.count("*").alias("_out")), "degrees")
        ins = settle(edges.groupBy("dst").agg(F.count("*").alias("_in")), "degrees")
        scaled = lookup(lookup(edges.select("src", "dst"), outs, "src", "inner"), ins, "dst", "inner")
        scaled = scaled.select("src", "dst", (1 / F.sqrt(F.col("_out").cast("double")) / F.sqrt(F.col("_in").cast("double"))).alias("scale"))
        scaled = settle(scaled, "edges")
        is_txn = {end: F.col(end) >= first_txn for end in ("src", "dst")}
        if not scaled.filter(is_txn["src"] == is_txn["dst"]).isEmpty():
            raise ValueError("every edge joins a transaction and an entity")
        return cls(
            spark,
            write_bucketed(scaled.filter(is_txn["dst"]), "dst", buckets, "inward"),
            write_bucketed(scaled.filter(is_txn["src"]), "src", buckets, "outward"),
            write_bucketed(nodes.select("node_id").filter(F.col("node_id") >= first_txn), "node_id", buckets, "txn"),
            settle(nodes.select("node_id").filter(F.col("node_id") < first_txn), "entities"),
            buckets,
        )

    def place(self, nodes: DataFrame, feat: str = "feat") -> tuple[DataFrame, DataFrame]:
        """``(node_id, feat)`` of transactions, bucketed like the edges, and of entities."""
        vectors = nodes.select("node_id", F.col(feat).alias("feat"))
        txn = vectors.join(self.txn, "node_id")
        return write_bucketed(txn, "node_id", self.buckets, "vectors"), settle(vectors.join(self.entities, "node_id"), "vectors")

    def _summed(self, sent: DataFrame, dim: int) -> DataFrame:
        dims = [f"h{i}" for i in range(dim)]
        parts = sent.select("dst", *spread(F.transform("feat", lambda x: x * F.col("scale")), dim))
        sums = parts.groupBy("dst").agg(*[F.sum(h).alias(h) for h in dims])
        return sums.select(F.col("dst").alias("node_id"), F.array(*dims).alias("feat"))

    def hop_frames(self, txn: DataFrame, entities: DataFrame, dim: int, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
        """One hop's vectors of transactions and of entities, not written yet."""
        from_txn = self.outward.join(txn.withColumnRenamed("node_id", "src").hint("merge"), "src")
        sources = entities.withColumnRenamed("node_id", "src")
        if measured_bytes(sources) <= broadcast_bytes:
            from_entities = self.inward.join(F.broadcast(sources), "src")
        else:
            from_entities = lookup(self.inward, sources, "src", "inner", broadcast_bytes=0)
        new = [
            all_.join(self._summed(sent, dim).hint("merge"), "node_id", "left").select("node_id", or_zeros(F.col("feat"), dim).alias("feat"))
            for all_, sent in ((self.txn, from_entities), (self.entities, from_txn))
        ]
        return new[0], new[1]

    def hop(self, txn: DataFrame, entities: DataFrame, dim: int, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
        """One symmetric-normalised convolution; the results lie as their inputs do."""
        new_txn, new_entities = self.hop_frames(txn, entities, dim, broadcast_bytes)
        return write_bucketed(new_txn, "node_id", self.buckets, "vectors"), settle(new_entities, "vectors")

    def propagate_k(self, nodes: DataFrame, dim: int, hops: int, feat: str = "feat", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """``(node_id, feat)``: vectors [X, AX, A^2 X, ...] side by side. Transactions are stacked where they lie."""
        txn, entities = self.place(nodes, feat)
        stacks = [txn, entities]
        for hop in range(1, hops + 1):
            txn, entities = self.hop(txn, entities, dim, broadcast_bytes)
            for i, here in enumerate((txn, entities)):
                add = here.select("node_id", F.col("feat").alias("_add"))
                stacks[i] = stacks[i].join(add.hint("merge"), "node_id").select("node_id", F.concat("feat", "_add").alias("feat"))
        return stacks[0].unionByName(stacks[1])
