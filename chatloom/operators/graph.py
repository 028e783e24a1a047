"""Connected components of an edge table, by rounds of minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import saved


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every end of ``edges(a, b)``.

    Each round takes the least label among a vertex and its neighbours, then the label of
    that label; long chains halve. Rounds are stored tables, so a lost executor costs one
    round at most. Labels are combined map-side, so a vertex of any degree is one row a task.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "components-edges")
    labels = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"), "components-0")
    for i in range(1, max_rounds + 1):
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
        now = low.join(jump, "component", "left").select("id", "was", F.least("component", F.coalesce("far", "component")).alias("component"))
        now = saved(now, f"components-{i}")
        labels = now.select("id", "component")
        if now.filter("was <> component").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
