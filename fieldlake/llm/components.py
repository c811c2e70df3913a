"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges(a, b); the label is one of the
    component's nodes.

    Each round points every node to its smallest neighbour, shortens the
    pointers by one step, and merges the ends of each remaining edge, so long
    chains fall in few rounds.  The rounds' pointers are followed at the end,
    in one plan.  Only whether an edge is left reaches the driver."""
    edges = edges.select("a", "b")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = stored(edges.where("a <> b").distinct(), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        further = up.select(F.col("a").alias("q"), F.col("p").alias("r"))
        up = stored(up.join(further, F.col("p") == F.col("q")).select("a", F.col("r").alias("p")), "pointers")
        rounds.append(up)
        from_a, from_b = up.select("a", F.col("p").alias("x")), up.select(F.col("a").alias("b"), F.col("p").alias("y"))
        edges = stored(edges.join(from_a, "a").join(from_b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
                       .where("a <> b").distinct(), "edges")
    labels = nodes.withColumn("label", F.col("node"))
    for up in rounds:
        labels = (labels.join(up.select(F.col("a").alias("_a"), F.col("p").alias("_p")), F.col("label") == F.col("_a"), "left")
                  .select("node", F.coalesce("_p", "label").alias("label")))
    return stored(labels, "labels")
