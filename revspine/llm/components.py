"""Connected components over an edge table of longs.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every step is one minimum per node
(combined before the shuffle) and one join (its hot node's rows are split by
Spark), so a node with any number of edges is never gathered in one place.
Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, hot_join


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another node; root is
    the smallest node of its component and is listed too."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before, now = None, _state(e)
    while now != before and now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = hot_join(both, low, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = hot_join(large, low, ["u"])
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small)
        before, now = now, _state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
