"""Connected components by contraction: no links, labels or components ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node that occurs in ``edges``; component is the smallest node of its component.

    Each round hooks every node to its smallest neighbour, jumps the pointers twice, and replaces the edges by
    those between the new labels. The edges shrink at least by half a round, so the rounds grow with the
    logarithm of the nodes. Hubs are harmless: the minimum over neighbours is pre-aggregated on the map side,
    and joins carry two columns with the label side unique per node. Null ends and self loops: an edge with a null end
    is ignored, a self loop only declares its node. Repeated edges count once. An empty input gives an empty result.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges_now = materialize(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    labels = None
    while True:
        sym = edges_now.unionByName(edges_now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = materialize(sym.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")))
        for _ in range(2):
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("g"))
            jumped = materialize(parent.join(up, "p", "left").select("u", F.coalesce("g", "p").alias("p")))
            discard(parent)
            parent = jumped
        if labels is None:
            labels = materialize(both.select(F.col("u").alias("node")).distinct().join(parent, F.col("node") == F.col("u"), "left").select("node", F.coalesce("p", "node").alias("component")))
        else:
            nxt = materialize(labels.join(parent, F.col("component") == F.col("u"), "left").select("node", F.coalesce("p", "component").alias("component")))
            discard(labels)
            labels = nxt
        to = parent.select("u", "p")
        moved = edges_now.join(to, "u").select(F.col("p").alias("a"), F.col("v").alias("u")).join(to, "u").select("a", F.col("p").alias("b"))
        nxt = materialize(moved.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
        discard(edges_now)
        discard(parent)
        edges_now = nxt
        if edges_now.isEmpty():
            discard(edges_now)
            return labels
