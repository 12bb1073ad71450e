"""Connected components by repeated contraction; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(node, component) for each node of the edges (a, b): the smallest node that it reaches.

    Each round points every node to its smallest neighbour, jumps over pointers, and contracts the edges. A node's rows are
    reduced by partial aggregation, so hubs don't pile up.
    """
    rows = edges.count()
    edges = scratch.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-0", rows)
    steps: list[DataFrame] = []
    spent = [f"{label}-0"]
    while rows := edges.count():
        n = len(steps) + 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = scratch.cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")), f"{label}-p{n}", 2 * rows)
        for k in range(2):
            further = parent.select(F.col("node").alias("to"), F.col("to").alias("further"))
            jumped = parent.join(further, "to").select("node", F.col("further").alias("to"))
            parent = scratch.cut(jumped, f"{label}-p{n}-{k}", 2 * rows)
        spent += [f"{label}-{n}", f"{label}-p{n}", *(f"{label}-p{n}-{k}" for k in range(2))]
        steps.append(parent)
        of = lambda side: parent.select(F.col("node").alias(side), F.col("to").alias(f"{side}2"))
        moved = edges.join(of("a"), "a").join(of("b"), "b").where("a2 <> b2")
        edges = scratch.cut(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), f"{label}-{n}", rows)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    nodes = steps[0].count()
    out = steps[0].select("node", F.col("to").alias("component"))
    for later in steps[1:]:
        out = out.join(later.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    out = scratch.cut(out, f"{label}-all", nodes)
    for name in spent:
        scratch.drop(name)
    return out
