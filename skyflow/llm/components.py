"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lineage import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """
    (node, label) of every node in `links`; label is the smallest node of its component. Alternating large and small
    stars: in each round every node's neighbours are linked to the smallest node that it sees, until nothing
    changes; a few rounds even for long chains. Minima are aggregated before the shuffle and a hot node is only a join key, so no task holds
    the neighbours of a node. Each round is written to the shared folder. Links with a null end and loops are left out.
    """
    x, y = F.col(a), F.col(b)
    edges = materialize(links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
