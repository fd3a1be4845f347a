"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) long -> (node, component): each node of an edge with the smallest id that it can reach.

    First the small-star step (Kiveris et al., 2014) is repeated: a node hands its smaller neighbours to the smallest of
    them, until each node has one smaller neighbour at most, so that a forest is left; then pointers are doubled up to the
    roots. The smallest neighbour is a combining aggregate that is written and joined back, and the doubling joins two written
    tables too, so a node with very many neighbours on either side is split by the skewed-join rule instead of filling a task. Only
    counts reach the driver. Nodes without edges (or with an edge to themselves alone) aren't returned.
    """
    u, v = F.col("u"), F.col("v")
    now = materialize(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where(u != v).distinct())
    while True:
        low = materialize(now.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        if not low.where("n > 1").limit(1).count():
            break
        handed = F.when(v == F.col("m"), F.struct(u.alias("u"), v.alias("v"))).otherwise(F.struct(v.alias("u"), F.col("m").alias("v")))
        now = materialize(now.join(low.select("u", "m"), "u").select(handed.alias("e")).select("e.*").distinct())
    while True:
        up = now.select(u.alias("p"), v.alias("q"))
        nxt = materialize(now.join(up, v == F.col("p"), "left").select("u", F.coalesce("q", "v").alias("v"), F.col("q").isNotNull().alias("moved")))
        now = nxt.select("u", "v")
        if not nxt.where("moved").limit(1).count():
            break
    return now.select(u.alias("node"), v.alias("component")).union(now.select(v.alias("node"), v.alias("component")).distinct())
