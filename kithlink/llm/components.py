"""Connected components of a graph given as pairs of node numbers, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(pairs: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of a pair.

    ``pairs`` has long columns u and v. Each round links a node's larger neighbours, then its smaller ones, to
    the least node next to it (large-star and small-star), so that every component becomes a star around its
    least node after a logarithmic number of rounds. A node's least neighbour is a partial aggregate; it is
    joined back, so a hub's edges are spread by skewed-join splitting and no neighbour list is gathered. Each
    round's edges are a table in the shared folder.
    """
    edges = materialise(
        pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = _both_ways(edges)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))  # v < u in every row here
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        small = small.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
        following = materialise(small, "edges")
        discard(large)
        discard(edges)
        edges, before = following, state
        state = _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components were not settled after {max_rounds} rounds")
    # every remaining edge leads from a node to its component's least node
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
