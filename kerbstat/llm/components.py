"""Connected components by alternating large and small stars, without a collect of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbstat.session import ensure_checkpoint_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the links; the component is its smallest node. Nodes are of type long.

    Minima are combined before the shuffle and joined back, so a node with very many links is not one task's work.
    Links with a null end and links of a node to itself connect nothing. Each round's links go to the checkpoint folder;
    rounds go on until one changes nothing.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna().filter("u <> v").distinct().checkpoint()
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = small.filter("u <> v").distinct().checkpoint()
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == known:
            break
        known = mark
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
