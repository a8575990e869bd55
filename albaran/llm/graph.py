"""Connected components of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from albaran.session import cut


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) of links (src, dst): component is the least node of the class.

    Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond"):
    each round is two shuffles with map-side combined minima; it ends when no link changes. Every round is cut by a
    checkpoint in the shared folder. Empty links give an empty result; a link of a node with itself gives the node.
    """
    ids = links.select("src", "dst").where("src is not null and dst is not null")
    nodes = ids.select(F.col("src").alias("node")).union(ids.select("dst")).distinct()
    edges = cut(ids.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    for _ in range(most_rounds):
        # large star: the larger neighbours of each node point to its least neighbour (or itself)
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the smaller neighbours and the node itself point to the least neighbour
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u")
        new = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = cut(new)
        same = new.count() == edges.count() and new.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = new
        if same:
            break
    else:
        raise RuntimeError("the components did not settle")
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
