"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .where(F.col("a") < F.col("b")).distinct())


def connected_components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Table (``node``, ``component``) of the nodes of ``edges`` (``a``, ``b``);
    a component is named by its smallest node.

    Each round points every node at its smallest neighbour, follows the
    pointers one step further and replaces the edges by the edges between the
    nodes pointed at. Pointers only go to smaller nodes of the same component,
    so the smallest stays, and the edges shrink until none is left. Only the
    question whether edges are left reaches the driver.
    """
    e = scratch.write(_ordered(edges), f"{name}-edges-0")
    comp = scratch.write(e.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                          .select("node", F.col("node").alias("component")), f"{name}-comp-0")
    i = 0
    while not e.isEmpty():
        i += 1
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = scratch.write(both.groupBy("a").agg(F.min("b").alias("p"))
                                 .select("a", F.least("a", "p").alias("p")), f"{name}-near-{i}")
        far = near.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jump = scratch.write(near.join(far, "p").select("a", F.col("pp").alias("p")),
                             f"{name}-jump-{i}")
        comp = scratch.write(
            comp.join(jump, F.col("component") == F.col("a"), "left")
                .select("node", F.coalesce("p", "component").alias("component")), f"{name}-comp-{i}")
        to_b = jump.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = e.join(jump, "a").join(to_b, "b").select(F.col("p").alias("a"), F.col("pb").alias("b"))
        e = scratch.write(_ordered(moved), f"{name}-edges-{i}")
        scratch.drop(f"{name}-edges-{i - 1}", f"{name}-comp-{i - 1}", f"{name}-near-{i}",
                     f"{name}-jump-{i}")
    return comp
