"""Connected components of links between documents, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import settle

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b); the root is the smallest node of its component.

    Large-star and small-star steps in turn: every node points its greater neighbours,
    and then its smaller ones, to the smallest of them, until nothing changes. Each step
    adds up per node before the shuffle and is written to the shared folder.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct(), "links")
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        least = settle(least.select("n", F.least("n", "m").alias("m")), "least")
        # the greater neighbours of a node point to the smallest of all its neighbours and itself
        large = settle(edges.join(least, edges["u"] == least["n"]).select("v", F.col("m").alias("u")).distinct(), "large")
        low = settle(large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m")), "low")
        # the smaller neighbours of a node, and the node, point to the smallest of them
        small = large.join(low, large["v"] == low["n"])
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v")
        new = settle(small.unionByName(low.select(F.col("n").alias("v"), F.col("m").alias("u"))).distinct(), "small")
        n_new = new.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("k")).first()
        inner = new.join(new.select(F.col("v").alias("x")).distinct(), new["u"] == F.col("x"), "left_semi")
        edges = new
        if n_new["n"] == n_new["k"] and inner.isEmpty():  # every node points to a root
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("u").distinct().select(F.col("u").alias("node"), F.col("u").alias("root"))
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)
