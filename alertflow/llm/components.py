"""Connected components of an undirected edge table by contraction.

Every round links each node to its smallest neighbour, follows the links to their
roots by pointer jumping, and replaces the edges by edges between roots. A
round at least halves the nodes that still have edges. All steps are joins and
map-side combined minima over tables written to the shared folder; AQE splits the
join partitions of a hub node. Nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import written


def _jumped(parents: DataFrame) -> DataFrame:
    """``node, root`` from ``node, root`` links that always go down in value."""
    while True:
        hop = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        step = written(parents.join(hop, "root", "left")
                       .select("node", F.coalesce("next", "root").alias("root"),
                               (F.col("next") < F.col("root")).alias("moved")), "cc-jump")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        parents = step.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, longs): root is the smallest of its component."""
    todo = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "cc-edges")
    found = None
    while not todo.isEmpty():
        both = todo.unionByName(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        links = _jumped(written(low.select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "cc-links"))
        if found is None:
            found = links
        else:
            new = links.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = written(found.join(new, "root", "left").select("node", F.coalesce("top", "root").alias("root")),
                            "cc-found")
        ra = links.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = links.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        todo = written(todo.join(ra, "a").join(rb, "b").where("ra <> rb")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
                       "cc-edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where(F.lit(False))
    return found
