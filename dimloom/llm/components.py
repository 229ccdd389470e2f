"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a partial-aggregate minimum per node and a join, so a node with
very many neighbours is no single task's work. Each round is written to the
shared folder, which cuts the lineage; the only values that reach the driver
are a count and a checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.operators.ids import materialize

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on its smallest neighbour."""
    if large:
        near = edges.union(edges.select("v", "u"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node with an edge to another; the component is its smallest node.

    Edges with a null end and loops are ignored. Raises if ``MAX_ROUNDS`` do
    not suffice (the rounds needed grow with the logarithm of the nodes).
    """
    now = materialize(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u != v").distinct(), "cc")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_star(_star(now, True), False), "cc")
        new = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == mark or not new[0]:
            leaf = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return leaf.union(now.select("v", "v").distinct())
        mark = new
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
