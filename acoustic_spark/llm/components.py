"""Connected components of links, by smallest labels with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of the
    label, so long chains need few rounds. Messages to a node are summed before the shuffle;
    adaptive execution splits hubs on the other side. Rounds are cut by written tables. Their joins
    are not broadcast, however small: the driver would hold three tables a round until it collects its garbage.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    edges = written(both.where("node <> other").distinct(), "edges")
    labels = written(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("component")), "labels")
    while True:
        messages = edges.join(labels.hint("merge"), "node").groupBy(F.col("other").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(messages.hint("merge"), "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        root = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = written(lower.join(root.hint("merge"), "component").select("node", "was", F.least("component", "root").alias("component")), "labels")
        moved = jumped.where("component <> was").limit(1).count()
        discard(labels)
        labels = jumped
        if not moved:
            discard(edges)
            found = labels.select("node", "component")
            found.written_at = labels.written_at
            return found
