"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every greater neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    )


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, root) of every node on an edge; the root is the component's smallest node.

    ``edges`` has long columns ``u`` and ``v``; loops and rows with a null are
    ignored.  Minima are aggregated before the shuffle and joined back, so a node
    with very many neighbours is never gathered.  Every round's edges are stored;
    rounds end when a round changes nothing.  No edges give no rows.
    """
    pairs = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").distinct()
    state = scratch.store(pairs, f"{name}-0")
    mark, step = None, 0
    while True:
        row = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(row) == mark or row[0] == 0:
            break
        mark, step = tuple(row), step + 1
        # The large star's edges run from a greater to a smaller node, as the small star wants them.
        state = scratch.store(_small_star(_large_star(state)).distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
