"""Connected components of an edge table, and the first-fit leaders of a graph whose nodes have an order; both in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import shared_folder


def cut(df: DataFrame, folder: str | None = None) -> DataFrame:
    """A reliable checkpoint, in the folder of spark.checkpoint.dir."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder or shared_folder(df.sparkSession))
    return df.checkpoint()


def _star(links: DataFrame) -> DataFrame:
    """For every (a, b) with b the smallest neighbour of a so far: a's other links are moved to it."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a")


def connected(edges: DataFrame, u: str, v: str, folder: str | None = None) -> DataFrame:
    """(node, root) of every node on an edge; root is the smallest node that is reachable.  Nulls and self-links count for nothing.

    Large-star and small-star rounds (Kiveris et al., 2014): larger neighbours, then smaller ones, are linked to the smallest.
    Minima are combined before the shuffle; rounds grow with the logarithm of a component's diameter, and a node's many
    links are never in one row."""
    a, b = F.greatest(u, v), F.least(u, v)
    links = cut(edges.where(F.col(u) != F.col(v)).select(a.alias("a"), b.alias("b")).distinct(), folder)
    state = None
    while state != (now := tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())):
        state = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        near = _star(large)
        small = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(near.select("a", F.col("m").alias("b"))).distinct()
        links = cut(small, folder)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def first_fit(nodes: DataFrame, edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, leader): going through the nodes in ascending order, each joins the smallest earlier leader that it has an edge with, or
    else becomes a leader itself.

    ``nodes`` has the column node, ``edges`` the columns a < b.  The leaders are the first maximal independent set in
    that order: in each round a node is settled as led once an earlier neighbour leads, and leads once all earlier
    neighbours are led.  Rounds are as many as the longest chain of such waiting, few unless edges form long paths."""
    links = cut(edges.where("a < b").select("a", "b").distinct(), folder)
    waiting, leads = links, cut(nodes.join(links.select(F.col("b").alias("node")).distinct(), "node", "left_anti").select("node"), folder)
    led = None
    while waiting.limit(1).count():
        hit = waiting.join(leads.select(F.col("node").alias("a")), "a", "left_semi").select("b").distinct()
        led = cut(hit if led is None else led.unionByName(hit).distinct(), folder)
        out = led.select(F.col("b").alias("node"))
        # what is led waits no more, and nobody waits for it
        left = cut(waiting.join(led, "b", "left_anti").join(out.withColumnRenamed("node", "a"), "a", "left_anti").select("a", "b"), folder)
        free = waiting.select(F.col("b").alias("node")).distinct().join(out, "node", "left_anti").join(left.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
        leads, waiting = cut(leads.unionByName(free).distinct(), folder), left
    own = leads.select("node", F.col("node").alias("leader"))
    home = links.join(leads.select(F.col("node").alias("a")), "a", "left_semi").join(leads.select(F.col("node").alias("b")), "b", "left_anti")
    return own.unionByName(home.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("leader")))
