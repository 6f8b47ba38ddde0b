"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) to node and component, the smallest node that its edges reach.

    Every round, nodes take the smallest label around them and then the label of their label, so
    rounds grow with the logarithm of a component's width. Labels are written each round; no
    group of rows is brought together but in sums and minima. Edges with a null are left out.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = staged(both.select("a", "b").unionAll(both.select("b", "a")).toDF("node", "other").distinct(),
                  "edges")
    labels = staged(both.groupBy("node").agg(
        F.least(F.min("other"), F.first("node")).alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), "component"), "other").groupBy(
            "node").agg(F.min("component").alias("near"))
        lower = labels.join(around, "node").select(
            "node", "component", F.least("component", "near").alias("near"))
        jumped = lower.join(labels.select(F.col("node").alias("near"), F.col("component").alias("far")),
                            "near", "left").select(
            "node", F.least("near", F.coalesce("far", "near")).alias("component"),
            (F.least("near", F.coalesce("far", "near")) < F.col("component")).alias("moved"))
        step = staged(jumped, "labels")
        labels = step.drop("moved")
        if step.where("moved").isEmpty():
            return labels
