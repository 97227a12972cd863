"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glimmerdex.plans.sizing import keyed_join, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the edges (a, b) the smallest node it can reach.

    Each round takes the smallest label among a node and its neighbours and then jumps to
    the label of that label, so long chains need few rounds. A round is written to the
    shared folder, which cuts the lineage. Many nodes may share a label: that join goes
    by broadcast behind a measured size and is salted beyond it.
    """
    links = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = written(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), F.col("root"))
        near = links.join(of_neighbour, "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        least = written(
            labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "least"
        )
        asked = least.select("root").distinct()
        jump = asked.join(least.select(F.col("node").alias("root"), F.col("root").alias("further")), "root")
        stepped = keyed_join(least, jump, ["root"], "node")
        labels = written(stepped.select("node", F.col("further").alias("root"), (F.col("further") != F.col("old")).alias("moved")), "labels")
        moved = labels.filter("moved").limit(1).count()
        labels = labels.select("node", "root")
        if not moved:
            return labels
