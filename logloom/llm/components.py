"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import kept
from logloom.shared import delete_folder


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); a root names its component.

    Each round every node moves to its least neighbour in a random but fixed
    order, and the edges between nodes that moved together vanish. The order
    makes even long chains shrink by a constant factor. Rounds are written, so
    lineage stays short; a round's tables go when the next one is written. A node with very many edges is reduced by partial
    minima, and the joins put one row per node against its edges, which
    adaptive execution can split.
    """
    spark = edges.sparkSession
    edges, edges_at = kept(
        edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    roots = roots_at = None
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.expr("array(struct(a AS node, b AS other), struct(b AS node, a AS other))")).alias("e"))
        least = (
            ends.select("e.*")
            .groupBy("node")
            .agg(F.expr("min(struct(xxhash64(other) AS r, other))").alias("m"))
            .select("node", F.expr("IF(m.r < xxhash64(node) OR m.r = xxhash64(node) AND m.other < node, m.other, node)").alias("to"))
        )
        least, least_at = kept(least, "moves")
        done = [edges_at]
        if roots is None:
            roots, roots_at = least.withColumnRenamed("to", "root"), least_at
        else:
            moved = least.select(F.col("node").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            done += [roots_at, least_at]
            roots, roots_at = kept(roots, "roots")
        a = least.select(F.col("node").alias("a"), F.col("to").alias("x"))
        b = least.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges, edges_at = kept(
            edges.join(a, "a").join(b, "b").where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        for folder in done:
            delete_folder(spark, folder)
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
