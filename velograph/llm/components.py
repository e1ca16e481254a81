"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from velograph.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b): the component is
    its smallest node.

    Every round points each node at its smallest neighbour, follows the pointers
    to their ends, and keeps only the links between different ends. A component
    that is not one node yet at least halves its nodes, so the rounds grow with
    the logarithm of the longest path. Each step is a written table.
    """
    edges = scratch.write(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                          .where("a <> b").distinct(), f"{name}-edges")
    nodes = None
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("next")).union(edges.select("b", "a"))
        points = scratch.write(both.groupBy("node").agg(F.min("next").alias("next"))
                               .select("node", F.least("node", "next").alias("next")), f"{name}-{step}")
        jump = 0
        while True:  # pointers only go down, so they end at nodes that point at themselves
            jump += 1
            ends = points.select(F.col("node").alias("next"), F.col("next").alias("end"))
            points = scratch.write(points.join(ends, "next").select("node", F.col("end").alias("next"),
                                                                    (F.col("end") != F.col("next")).alias("moved")),
                                   f"{name}-{step}-{jump}")
            moved = not points.where("moved").isEmpty()
            points = points.select("node", "next")
            if not moved:
                break
        if nodes is None:
            nodes = points.withColumnRenamed("next", "component")
        else:
            nodes = (nodes.join(points.withColumnRenamed("node", "component"), "component", "left")
                     .select("node", F.coalesce("next", "component").alias("component")))
        nodes = scratch.write(nodes, f"{name}-{step}-nodes")
        a, b = (points.select(F.col("node").alias(x), F.col("next").alias(f"{x}_to")) for x in "ab")
        edges = (edges.join(a, "a").join(b, "b").where("a_to <> b_to")
                 .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
        edges = scratch.write(edges, f"{name}-{step}-edges")
    if nodes is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).where("false")
    return nodes
