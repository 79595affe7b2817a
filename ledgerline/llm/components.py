"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is the smallest node of its component.

    Each round a node takes the smallest label among its neighbours' and then that label's own label,
    so labels travel twice as far each round; the loop ends when no label changes. A node with very
    many links is a key of a partially aggregated minimum and never a task of its own. No links: empty.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(seen, labels.node == seen.a).select("node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        up = labels.select(F.col("node").alias("mid"), F.col("root").alias("top"))
        labels = stored(step.join(up, "mid").select("node", F.least("mid", "top").alias("root"), (F.least("mid", "top") != F.col("old")).alias("moved")), "labels")
        if not labels.where("moved").limit(1).count():
            return labels.select("node", "root")
