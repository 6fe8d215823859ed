"""Connected components of an edge table by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import land


def components(edges: DataFrame) -> DataFrame:
    """Per node of the edges (x, y: long): `node`, `label`. Nodes have one label if and only if a path joins them.

    In each round every node goes to the smallest of itself and its neighbours, edges
    follow their ends, and edges within one node vanish. Node numbers should be random
    (hashes): then a constant share of the nodes vanishes in each round, so there are
    about log(n) rounds, also for long chains; a star or a clique takes one.
    """
    edges = land(edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).filter("x < y").distinct(), "edges")
    labels = None
    while edges.take(1):
        ends = edges.select(F.col("x").alias("node"), F.col("y").alias("other")).unionAll(edges.select("y", "x"))
        parents = land(ends.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("parent")), "parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            to = parents.select(F.col("node").alias("from"), "parent")
            labels = land(labels.join(to, labels["label"] == to["from"], "left").select("node", F.coalesce("parent", "label").alias("label")), "labels")
        a, b = parents.select(F.col("node").alias("x"), F.col("parent").alias("a")), parents.select(F.col("node").alias("y"), F.col("parent").alias("b"))
        moved = edges.join(a, "x").join(b, "y").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        edges = land(moved.filter("x < y").distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("x").alias("node"), F.col("y").alias("label"))
