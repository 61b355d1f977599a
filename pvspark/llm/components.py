"""Connected components of a link table, as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pvspark.llm.common import materialise


def components(links: DataFrame, max_rounds: int = 100, materialise=materialise) -> DataFrame:
    """``links(a, b)`` -> (node, label): the least node of each node's component.

    Every round takes the least label among the neighbours, then the label of that label, so long chains
    halve. Each round ends in a written table; no link is collected. Labels combine map-side, and the joins
    are on nodes, whose label table has one row each. Nodes may be structs; self-links and repeats do no
    harm; no links give no rows. ``materialise`` writes the tables between rounds.
    """
    edges = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                        .distinct(), "links")
    labels = materialise(edges.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = (edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        low = (labels.join(near, labels["node"] == near["a"])
               .select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        low = materialise(low, "labels")
        jump = low.select(F.col("node").alias("at"), F.col("label").alias("further"))
        new = materialise(low.join(jump, low["label"] == jump["at"])
                          .select("node", "further", (F.col("further") != F.col("old")).alias("moved")), "labels")
        labels = new.select("node", F.col("further").alias("label"))
        if new.filter("moved").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def hooked(links: DataFrame, write) -> DataFrame:
    """``links(a, b)`` -> (node, label): the least label among the neighbours of the least neighbours. Nodes of one label are
    connected, and a star has one label; chains may have several. Two aggregations, to contract what has been found
    between rounds of comparing."""
    ends = links.select("a", "b")
    edges = write(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .unionByName(ends.select("a", F.col("a").alias("b"))).unionByName(ends.select(F.col("b").alias("a"), "b")), "hooks")
    least = write(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")), "hooked")
    return write(edges.join(least, edges["b"] == least["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label")), "hooked")
