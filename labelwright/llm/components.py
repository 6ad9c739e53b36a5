"""Connected components of a table of links, by alternating star contraction.

Each round points every node at the smallest neighbour of its neighbours, so the number of
rounds grows with the logarithm of the longest chain. Rounds are written tables; nothing but
two sums per round reaches the driver. Minima are combined before the shuffle, and the joins
have two shuffled sides, so a hub is split like any skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from labelwright.sources.scratch import store


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest of the node and its neighbours."""
    sym = _both(edges)
    joined = sym.where("v > u").join(_smallest(sym), F.col("u") == F.col("_u"))
    return joined.select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below move to the smallest of them; edges point down."""
    least = _smallest(edges)
    joined = edges.join(least, F.col("u") == F.col("_u"))
    moved = joined.where("v > _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.unionByName(least.select(F.col("_u").alias("u"), F.col("_m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v), root being the smallest of its component."""
    down = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    down, before = store(down, "links"), None
    while True:
        mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        now = tuple(down.agg(F.count(F.lit(1)), mark).first())
        if now == before or not now[0]:
            break
        before = now
        down = store(_small_star(_large_star(down)), "links")
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
