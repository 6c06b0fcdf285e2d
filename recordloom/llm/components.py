"""Connected components of an edge table, without collecting edges, nodes or labels anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes under the edges (a, b)."""
    root = np.arange(n, dtype=np.int64)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame, scratch: Scratch, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that an edge touches; root is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): each node links its larger neighbours, then
    its smaller ones, to its smallest neighbour, until nothing changes.  Minima are combined before the shuffle, and
    they are written before they are joined back, so that Spark can split the join of a node with very many
    neighbours.  Nulls and self-links are ignored; an empty edge table gives an empty result.
    """
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a > b").distinct()
    e, last, k = scratch.save(e, "cc0"), None, 0
    while (now := _state(e)) != last:
        last, k = now, k + 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.save(both.groupBy("a").agg(F.min("b").alias("lo")).select("a", F.least("lo", "a").alias("lo")), f"low{k}")
        # a node without smaller neighbours is its own minimum
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("lo").alias("b"))
        large = scratch.save(large.distinct(), f"large{k}")
        low2 = scratch.save(large.groupBy("a").agg(F.min("b").alias("lo")), f"lower{k}")
        small = large.join(low2, "a").select(F.col("b").alias("a"), F.col("lo").alias("b")).where("a > b")
        nxt = scratch.save(small.unionByName(low2.select("a", F.col("lo").alias("b"))).distinct(), f"cc{k}")
        scratch.drop(f"cc{k - 1}", f"low{k}", f"large{k}", f"lower{k}")
        e = nxt
    members = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
