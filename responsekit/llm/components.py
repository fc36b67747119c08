"""Connected components by contraction, on tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.session import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u, v), written; the label is the component's smallest node.

    Each round hangs every node below its smallest neighbour, follows these
    pointers to the roots of the trees they form, and replaces both ends of
    every edge by their roots, until no edge is left. Parents always are smaller
    nodes, so this ends, and a node that has a parent is in no later edge, so it
    gets one only. Every step is a written table, so a lost executor repeats one
    step at most; a table goes when the next one is written."""
    edges = _oriented(edges.select("u", "v"))
    trees = []
    while not edges.isEmpty():
        tree = _to_roots(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")))
        trees.append(tree)
        moved = edges
        for end in ("u", "v"):
            root = tree.select(F.col("node").alias(end), "label")
            moved = moved.join(root, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
        moved = _oriented(moved)
        discard(edges)
        edges = moved
    if not trees:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    discard(edges)
    pointers = trees[0]
    for tree in trees[1:]:
        pointers = pointers.unionByName(tree)
    pointers = _to_roots(pointers)
    roots = pointers.select(F.col("label").alias("node")).distinct()
    out = materialize(pointers.unionByName(roots.select("node", F.col("node").alias("label"))))
    for table in (*trees, pointers):
        discard(table)
    return out


def _to_roots(pointers: DataFrame) -> DataFrame:
    """Pointers (node, label) doubled until each label is a root; written."""
    pointers = materialize(pointers.select("node", "label"))
    while True:
        above = pointers.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        moved = materialize(pointers.join(above, "label", "left").select(
            "node", F.coalesce("higher", "label").alias("label"), F.col("higher").isNotNull().alias("moved")))
        if moved.where("moved").isEmpty():
            discard(moved)
            return pointers
        discard(pointers)
        table, pointers = moved, moved.select("node", "label")
        pointers._materialized_path = table._materialized_path


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each, without loops; written."""
    return materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
