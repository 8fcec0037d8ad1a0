"""Connected components of a distributed list of links.

Rounds of two steps: every node takes the least label among its neighbours',
then labels jump to their labels' labels. Minima are summed up by partial
aggregation and labels meet links in joins that Spark may split, so a node with
a third of all links is no single task's work. Each round is written to the
shared folder; only a count of changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import common as C


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; ``root`` is the least node.

    Self links and repeated links change nothing; no links give no rows. Links are
    computed once: computed again, rows in another order may give other ones.
    """
    spark = links.sparkSession
    links = C.materialise(links.select("a", "b"), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = C.materialise(both, "links")
    labels = C.materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    for _ in range(max_rounds):
        labels = C.settled(spark, "labels", lambda own=labels: _round(both, own))
        if labels.filter("moved").limit(1).count() == 0:
            break
        labels = labels.select("node", "root")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return labels.select("node", "root")


def _round(both: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, root, moved`` after a step to the neighbours' labels and one to labels' labels."""
    seen = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").select("a", "near")
    lowest = seen.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
    hooked = labels.join(lowest, "node", "left").select("node", F.col("root").alias("was"), F.least("root", F.coalesce("near", "root")).alias("root"))
    hooked = C.materialise(hooked, "labels")
    up = hooked.select(F.col("node").alias("root"), F.col("root").alias("up"))
    again = hooked.join(up, "root", "left").select("node", "was", F.least("root", F.coalesce("up", "root")).alias("root"))
    return again.select("node", "root", (F.col("was") != F.col("root")).alias("moved"))
