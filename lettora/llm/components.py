"""Connected components of an edge list, by contraction.

Every round gives each node its smallest neighbour as parent, shortens the parent chains by pointer jumping, and contracts
the edges to parents. Each tree of a round collapses to one node, so nodes at least halve per round. Edges, parents and
labels are tables in the shared folder: nothing is collected, lineage stays short, and a lost executor costs a reread.
A node of very many edges is a hot join key only on the side that Spark splits (``skew_join``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettora.operators.skew import skew_join
from lettora.sources.shared import written


def _distinct_edges(edges: DataFrame) -> DataFrame:
    low, high = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    return edges.where("u <> v").select(low, high).distinct()


def _jumped(parents: DataFrame) -> DataFrame:
    """Chains of parents shortened until every node names its root."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        joined = skew_join(parents, above, ["parent"], "left")
        parent = F.coalesce("grand", "parent")
        parents = written(joined.select("node", parent.alias("parent"), (parent != F.col("parent")).alias("moved")), "cc")
        if parents.where("moved").isEmpty():
            return parents.drop("moved")
        parents = parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges ``u``, ``v`` (any orderable type); ``root`` is the smallest node reached.

    Repeated edges and loops change nothing; a node that only has loops, or none, is not listed.
    """
    edges = written(_distinct_edges(edges), "cc")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        near = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near"))
        parents = _jumped(written(near.select("node", F.least("node", "near").alias("parent")), "cc"))
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            above = parents.select(F.col("node").alias("root"), "parent")
            renamed = skew_join(labels, above, ["root"], "left")
            labels = written(renamed.select("node", F.coalesce("parent", "root").alias("root")), "cc")
        of_u = parents.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        of_v = parents.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        moved = skew_join(skew_join(edges, of_u, ["u"]), of_v, ["v"])
        edges = written(_distinct_edges(moved.select(F.col("pu").alias("u"), F.col("pv").alias("v"))), "cc")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return labels
