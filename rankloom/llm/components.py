"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankloom.runtime import materialize


def fewer_links(links: DataFrame) -> DataFrame:
    """Links ``(a, b)``, b larger, with the same components: each larger node keeps its smallest neighbour, and what its
    other neighbours lose is a link from them to that one. Where many nodes share neighbours, these links fall together.
    """
    pairs = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high <> low")
    least = pairs.withColumn("least", F.min("low").over(W.partitionBy("high")))
    # The link to the smallest neighbour stands for itself, one to any other neighbour for a link between the two.
    kept = least.select(F.col("least").alias("a"), F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("b"))
    return kept.distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for every node of ``links`` (a, b: long).

    Each round takes the smallest label among a node's neighbours, then that label's own label, so labels travel twice
    as far in every round. Stars, which is what most groups of copies are, take two rounds. All steps are joins and
    combinable minima; a round's labels are a stored table.
    """
    links = materialize(fewer_links(links), "fewer-links")
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = nearer.join(jump, "next").select("node", F.least("next", "far").alias("label"), "old")
        after = materialize(moved, "labels")
        if after.where("label < old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
