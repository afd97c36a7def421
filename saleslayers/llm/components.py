"""Connected components of an edge table, by contraction: no component ever meets in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslayers.llm.common import written


def _roots(parents: DataFrame) -> DataFrame:
    """Every vertex (v) with the root (p) of its tree, by doubling the way up until nothing moves."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        jumped = written(parents.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "roots")
        parents = jumped.select("v", "p")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """For each vertex of the edges (u, v), its component's smallest vertex: columns v and component.

    Each round hangs every vertex below its least neighbour and merges each tree into its root, which
    at least halves the vertices that still have edges. Repeated edges and loops are harmless.
    """
    edges = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mapping = None
    while mapping is None or not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("v"), F.least("u", "least").alias("p"))
        roots = _roots(written(hung, "parents"))
        if mapping is None:
            mapping = roots.select("v", F.col("p").alias("component"))
        else:
            moved = roots.select(F.col("v").alias("component"), "p")
            mapping = mapping.join(moved, "component", "left").select("v", F.coalesce("p", "component").alias("component"))
        mapping = written(mapping, "components")
        left, right = roots.select(F.col("v").alias("u"), F.col("p").alias("pu")), roots.select("v", F.col("p").alias("pv"))
        edges = edges.join(left, "u").join(right, "v").where("pu <> pv")
        edges = written(edges.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")
    return mapping
