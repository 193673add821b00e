"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import store


#: Parts of a node's edges, so that a hub's edges are joined in as many tasks.
PARTS = 32


def _digest(edges: DataFrame) -> tuple:
    """Two digests of 64 bits, and the number of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def _with_least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """edges and m, the least of a node and its neighbours: summed by part of its edges, then by node, and joined by part."""
    edges = edges.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
    parts = edges.groupBy(node, "part").agg(F.min(other).alias("m"))
    least = parts.groupBy(node).agg(F.min("m").alias("m"), F.collect_set("part").alias("parts"))
    least = least.select(node, F.least(node, "m").alias("m"), F.explode("parts").alias("part"))
    return edges.join(least, [node, "part"])


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(id, component_id) for each end of `edges` (a, b); component_id is the smallest id reachable.

    Each round links every node to the smallest of its neighbours; hubs are aggregated before they are
    shuffled and joined in parts. Rounds grow with the logarithm of the longest path. An empty edge table
    gives an empty result; nulls and self links are ignored.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    e = store(e, folder, f"{name}-0")
    before, n = _digest(e), 0
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        far = _with_least(both, "u", "v").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        big = far.where("a < b").distinct()
        near = _with_least(big, "b", "a").select("m", "a", "b")
        small = near.select(F.col("m").alias("a"), "b").union(near.select(F.col("m").alias("a"), F.col("a").alias("b")))
        n += 1
        e = store(small.where("a < b").distinct(), folder, f"{name}-{n}")
        after = _digest(e)
        if after == before:
            break
        before = after
    found = e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component_id"))
    return found.union(e.select("a", "a").distinct()).groupBy("id").agg(F.min("component_id").alias("component_id"))
