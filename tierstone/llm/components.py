"""Connected components of a graph given by its links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Point each node's larger neighbours to the smallest of node and neighbours."""
    swapped = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    both = links.unionByName(swapped)
    least = both.groupBy("src").agg(F.min("dst").alias("low"))
    least = least.select("src", F.least("src", "low").alias("low"))
    return both.join(least, "src").where("dst > src").select(
        F.col("dst").alias("src"), F.col("low").alias("dst")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Point each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("src").agg(F.min("dst").alias("low"))
    moved = links.join(least, "src").where("dst <> low")
    return (
        moved.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        .unionByName(least.select("src", F.col("low").alias("dst")))
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (src, dst); the component is its smallest node.

    Alternating large and small stars until nothing changes: rounds grow with the
    logarithm of a component's size. Each round is written to the shared folder, so
    a lost executor repeats one round at most; the driver sees one checksum a round.
    Loops are dropped, links may repeat and point either way.
    """
    ordered = links.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    now, before = stored(ordered.distinct(), "links"), None
    while True:
        seen = now.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("sum")
        ).first()
        if seen["n"] == 0 or tuple(seen) == before:
            break
        before = tuple(seen)
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    leaves = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return leaves.unionByName(roots)
