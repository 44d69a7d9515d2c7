"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import lookup
from tessera.session import cut


def _signature(edges: DataFrame) -> tuple:
    """Order-free signature of a set of edges, computed by one aggregate."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node of each component, for every node of an edge table (u, v).

    Nodes may be of any orderable type.  Rows with a null end and self-loops link nothing (a node that
    has only those is not in the result).  Every round aggregates minima map-side, so a hub of any degree costs
    one value per map task, and edges of hubs meet their minimum by broadcast instead of in one task (``lookup``); edges are
    kept in the shared checkpoint folder between rounds.
    """
    e = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _signature(e)
    for _ in range(max_rounds):
        # large star: neighbours larger than a node are tied to the node's smallest neighbour
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup(both, least, "u", 2 * before[0]).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself are tied to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup(large, least, "u", 2 * before[0]).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = cut(small.where("u <> v").distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
