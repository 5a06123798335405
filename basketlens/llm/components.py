"""Connected components as alternating star contractions over an edge table.

Both steps are an aggregate and a join on the node, so a hub is summed on the
map side and its edges are split by the skew join. Every round is written to
the workspace: lineage stays short and nothing is gathered on the driver but
two counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.sources.staging import Workspace


FILE_EDGES = 1_000_000


def _pulled(edges: DataFrame, near: DataFrame) -> DataFrame:
    """Edges (a, b) with the smallest node next to, or equal to, a."""
    low = near.groupBy("a").agg(F.min("b").alias("low"))
    return edges.join(low.select("a", F.least("a", "low").alias("low")), "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node it touches."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        _pulled(both, both).where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pulled = _pulled(down, down)
    return (
        pulled.select(F.col("b").alias("a"), F.col("low").alias("b"))
        .union(pulled.select("a", F.col("low").alias("b")))
        .where(F.col("a") != F.col("b")).distinct()
    )


def components(edges: DataFrame, space: Workspace, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Null ends, loops and repeated edges change nothing. Smallest nodes
    themselves have a row too.
    """
    usable = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = space.save(usable.select("a", "b").distinct(), f"{name}-0")
    state: tuple | None = _state(now)
    turn = 0
    while state[0]:
        turn += 1
        # A round leaves about as many edges; a file for each million is enough.
        files = 1 + state[0] // FILE_EDGES
        nxt = space.save(_small_star(_large_star(now)).coalesce(files), f"{name}-{turn}")
        new = _state(nxt)
        space.drop(f"{name}-{turn - 1}")
        now, done, state = nxt, new == state, new
        if done:
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)


def _state(edges: DataFrame) -> tuple[int, int | None]:
    """Edge count and an order-free hash; equal before and after means stars only."""
    h: Column = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(h)).first()
    return row[0], row[1]
