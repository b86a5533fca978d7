"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that occurs in ``edges`` (a, b); component is the smallest node reachable.

    Each round hangs every node on the smallest node of its neighbourhood, first from the side of the smaller, then
    of the larger end; the rounds needed grow with the logarithm of the graph. A node with very many edges is met
    through a partial minimum and a join that Spark can split, never gathered in one group. Each round is a written
    table. NULL ends and loops are left out.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = materialise(e, "edges"), None
    while True:
        mark = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before or mark[0] == 0:
            break
        before = mark
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
