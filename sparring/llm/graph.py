"""Connected components by contraction, for link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparring.session import materialize, release


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `links` (a, b); the component is its smallest node.

    In each round every node points to its smallest neighbour if that is smaller, chains of pointers are halved until
    they end, and links are contracted to the nodes they point to. Each step is written to the staging folder, and deleted
    when the next one stands there.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    links = materialize(links.select(a.alias("a"), b.alias("b")).where(F.col("a") != F.col("b")).distinct(), "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    labels = materialize(labels, "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        points = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        points = materialize(points, "points")
        while True:
            ahead = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
            once = points.join(ahead, "to").select("node", F.col("next").alias("to"))
            further = once.join(ahead, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved"))
            further = materialize(further, "points")
            release(points)
            points = further
            if further.where("moved").isEmpty():
                break
        renamed = points.select(F.col("node").alias("component"), "to")
        named = labels.join(renamed, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        named = materialize(named, "labels")
        release(labels)
        labels = named
        ends = [points.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b")]
        left = links.join(ends[0], "a").join(ends[1], "b").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        left = materialize(left.where(F.col("a") != F.col("b")).distinct(), "links")
        release(links, points)
        links = left
    release(links)
    return labels
