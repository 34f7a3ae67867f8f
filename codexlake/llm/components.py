"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected(links: DataFrame, scratch: Scratch, most_rounds: int = 100) -> DataFrame:
    """(node, label) for every node of links (a, b); label is the smallest node
    that can be reached. Each round every root takes the smallest root next to
    it, chains are shortened to their ends, and links are renamed to roots; the
    number of roots at least halves, so rounds grow with its logarithm. Each
    round's tables are dropped when the next one's stand.

    Defined cases: a link of a node with itself names the node; repeated links
    and links given both ways count once; no links give no rows; nulls at either
    end are no link; nodes may be of any type that sorts."""
    links = links.filter("a is not null and b is not null")
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = scratch.put(ends.select("node", F.col("node").alias("label")), "labels")
    edges = scratch.put(links.filter("a != b").select("a", "b").distinct(), "edges")
    for _ in range(most_rounds):
        if not edges.take(1):
            return labels
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        up = scratch.put(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), "up")
        while True:
            q = up.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            last, jumped = up, scratch.put(up.join(q, "p", "left").select("u", "p", F.coalesce("pp", "p").alias("pp")), "jump")
            moved = jumped.filter("p != pp").take(1)
            up = jumped.select("u", F.col("pp").alias("p"))
            up._scratch = jumped._scratch
            scratch.drop(last)
            if not moved:
                break
        name = lambda x: up.select(F.col("u").alias(x), F.col("p").alias("p" + x))
        had = labels, edges
        labels = scratch.put(labels.join(name("label"), "label", "left").select("node", F.coalesce("plabel", "label").alias("label")), "labels")
        renamed = edges.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
        edges = scratch.put(renamed.filter("a != b").distinct(), "edges")
        scratch.drop(up, *had)
    raise RuntimeError("components did not settle")
