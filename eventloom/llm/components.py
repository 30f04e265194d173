"""Connected components of an edge table, by least labels with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``key`` and ``component`` (least key reachable) for every end of an edge (a, b).

    A round takes the least label among the neighbours and then that label's own
    label, so the rounds grow with the logarithm of a chain's length. Each round
    is written, so lineage stays short.
    """
    both = written(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("component").alias("near"))
        step = labels.join(near, "key").select("key", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = labels.select(F.col("key").alias("new"), F.col("component").alias("far"))
        step = step.join(jump, "new", "left").select("key", "old", F.least("new", "far").alias("component"))
        step = written(step, "labels")
        labels = step.select("key", "component")
        if step.where("component <> old").isEmpty():
            return labels
