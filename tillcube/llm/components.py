"""Connected components of links, by rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.sources.shared import materialize


def _to_lowest(links: DataFrame, keep_own: bool) -> DataFrame:
    """Join the neighbours of each node to the lowest of them. Links of one node may be a large
    share of all: they are summed up before they move, and the join can split them."""
    lowest = links.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("low"))
    joined = links.join(lowest, "node").select(F.col("other").alias("node"), F.col("low").alias("other"))
    if keep_own:
        joined = joined.union(lowest.select("node", F.col("low").alias("other")))
    return joined.where("node != other")


def stars(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node in ``links`` (``node``, ``other``) but the roots themselves: the root is
    the lowest node reachable.

    Each round joins all larger neighbours of a node to its lowest one, then all smaller ones; long chains
    halve with every round. Each round is written, so its lineage is short and lost executors cost one round.
    """
    links = materialize(links.where("node > other").distinct(), "links")
    seen = None
    while True:
        both = links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _to_lowest(both, keep_own=False).where("node > other").distinct()
        small = _to_lowest(large, keep_own=True).where("node > other").distinct()
        links = materialize(small, "links")
        # Two numbers tell whether a round changed anything.
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first())
        if now == seen:
            return links.select("node", F.col("other").alias("root"))
        seen = now
