"""Connected components of a link table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.plans.sizing import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of links (a long, b long); label is the component's smallest node.

    Each round a node takes the smallest label among its own and its neighbours', then its label's
    label. Rounds end when no label changes; each is written to the shared folder. Neighbours are only
    ever aggregated, so a node with very many links is no problem.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        theirs = labels.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        offered = both.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        lower = labels.join(offered, "node").select("node", F.col("label").alias("was"), F.least("label", "theirs").alias("label"))
        hops = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = lower.join(hops, "label").select("node", F.least("label", "next").alias("label"), "was")
        moved = stored(moved, "labels")
        changed = moved.where("label != was").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
