"""Connected components of an edge table, by minimum labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphtables.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """id, comp for every end of ``edges`` (a, b): comp is the smallest id that is reachable.

    Every round each vertex takes the smallest label among its neighbours, and then the label of
    that label. It ends when a round changes nothing. Each round is a table in the shared folder.
    The vertex side of every join is unique, and the edges are files, so hubs can be split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b")
    both = settled(both.distinct(), "edges")
    labels = settled(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("id"), F.least("a", "low").alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("low"))
        taken = labels.join(near, "id").select("id", "comp", F.least("comp", "low").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        new = taken.join(jump, "next").select("id", F.least("next", "far").alias("comp"), (F.least("next", "far") < F.col("comp")).alias("moved"))
        new = settled(new, "labels")
        labels = new.select("id", "comp")
        if new.where("moved").isEmpty():
            return labels
