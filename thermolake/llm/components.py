"""Connected components by contraction, as joins and aggregations.

In each round every node takes the smallest id among itself and its neighbours, edges are mapped to
these ids, and loops and repetitions drop out. Each round merges every node that has a smaller
neighbour, so the rounds grow with the logarithm of a component's size; stars take one. The smallest
node of a component always keeps its id, so that is where all of it ends.

Intermediate tables are stored, which lets Spark split a hub's rows in its joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b); component is the smallest node."""
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    left = stored(edges.filter("a <> b").select(*pair).distinct(), "edges")
    maps = []
    while not left.isEmpty():
        # The smallest neighbour: of b among its a, of a itself, as a < b on every edge.
        both = left.select(F.col("b").alias("node"), F.col("a").alias("to")).union(left.select(F.col("a"), F.col("b")))
        smallest = stored(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")), "hubs")
        maps.append(smallest)
        mapped = left.join(smallest, left["a"] == smallest["node"]).select(F.col("to").alias("a"), "b")
        again = smallest.select(F.col("node").alias("n2"), F.col("to").alias("t2"))
        mapped = stored(mapped.join(again, F.col("b") == F.col("n2")).select("a", F.col("t2").alias("b")).filter("a <> b"), "mapped")
        left = stored(mapped.select(*pair).distinct(), "edges")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = maps[0].select("node", F.col("to").alias("component"))
    for step in maps[1:]:
        labels = stored(labels, "labels")
        labels = labels.join(step.withColumnRenamed("node", "from"), F.col("component") == F.col("from"), "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return stored(labels, "components")
