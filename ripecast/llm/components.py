"""Connected components of a graph of numbered vertices, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """vertex, root (smallest vertex reachable) of every vertex on an edge (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label, so the rounds grow with
    the logarithm of a component's diameter. Rounds are written to the shared folder. Nulls are ignored.
    """
    own = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select("a", "b")
    both = store(own.unionByName(own.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("m")).select("vertex", F.least("vertex", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("vertex").alias("b"), "root"), "b").groupBy(F.col("a").alias("vertex")).agg(F.min("root").alias("near"))
        step = labels.join(near, "vertex").select("vertex", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("vertex").alias("root"), F.col("root").alias("far"))
        new = store(step.join(jump, "root").select("vertex", "was", F.least("root", "far").alias("root")), "labels")
        labels = new.select("vertex", "root")
        if new.where(F.col("root") < F.col("was")).isEmpty():
            return labels
