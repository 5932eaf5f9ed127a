"""Connected components of a link table, with the links kept distributed.

Alternating star contraction: every node sends its larger neighbours, then its
smaller ones, to its smallest neighbour, until nothing changes.  Minima combine
map-side, each round is written to the shared folder, and only a count and a
checksum of the links reach the driver.  A node with very many links needs no
more than one row a link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest of it and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below move to the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes with links; the component is its smallest node."""
    now = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(now)
    while state[0]:
        now = stage(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
