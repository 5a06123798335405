"""Fact-to-dimension joins that hold when one key owns a third of the rows."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is sent to every executor only below this estimated size.
BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes that a stored byte of a compressed, dictionary-coded table may become as
# a row in memory. Sizes of files understate a table that much.
EXPANSION = 32
# Above it, keys with more fact rows than this are spread over several tasks.
HOT_ROWS = 5_000_000


def estimated_bytes(df: DataFrame) -> int:
    """Upper estimate of a lookup table's size from Catalyst's statistics.

    Without column statistics Catalyst multiplies the sizes of joined tables.
    A lookup table joined only to its own lookups cannot outgrow what it
    reads, so the sum over the scans, times what files expand to, bounds it.
    """
    if not hasattr(df, "_jdf"):
        return sys.maxsize  # no access to statistics: take the path for any size
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    scanned = sum(
        int(str(leaf.stats().sizeInBytes()))
        * (EXPANSION if leaf.getClass().getSimpleName() == "LogicalRelation" else 1)
        for leaf in (leaves.apply(i) for i in range(leaves.size()))
    )
    return scanned


def is_large(dim: DataFrame, broadcast_bytes: int | None = None) -> bool:
    """Whether a lookup table is too large, by estimate, to be sent to every executor."""
    return estimated_bytes(dim) > (BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes)


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    key_rows: Callable[[], DataFrame] | None = None,
    broadcast_bytes: int | None = None,
    hot_rows: int | None = None,
    identity: Sequence[str] = (),
) -> DataFrame:
    """Join a many-row side to a table holding one row per ``key``.

    A dimension whose estimated size is at most ``broadcast_bytes`` (by default
    BROADCAST_BYTES) is broadcast. A larger one goes through a shuffle in which
    each hot key (more than ``hot_rows`` fact rows, by default HOT_ROWS) is cut into ``ceil(rows / hot_rows)`` parts: fact
    rows pick a part from a hash of their content, so a retried task picks the
    same one, and the single dimension row is repeated once per part.

    ``identity`` names columns of ``facts`` that tell rows apart; the part is
    a hash of those. Without it all other columns are hashed, which spreads no
    better than they vary.

    ``key_rows`` may supply a cheaper frame to find hot keys in than ``facts``,
    such as the key column of the stored table. It only steers the load.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if not is_large(dim, broadcast_bytes):
        return facts.join(F.broadcast(dim), key, how)
    counted = key_rows() if key_rows else facts
    return _salted_join(
        facts, dim, key, how, counted, HOT_ROWS if hot_rows is None else hot_rows, identity
    )


def _salted_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    counted: DataFrame,
    hot_rows: int,
    identity: Sequence[str],
) -> DataFrame:
    # One row per hot key. There can be no more of them than
    # fact rows / hot_rows, each two longs wide.
    hot = (
        counted.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > hot_rows) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("bigint").alias("_parts"))
    )
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    # Rows without a key match nothing; spread them instead of piling them up.
    fact_parts = F.when(F.col(key).isNull(), F.lit(1024)).otherwise(parts)
    others = list(identity) or [c for c in facts.columns if c != key] or [key]
    salted_facts = (
        facts.join(F.broadcast(hot), key, "left")
        .withColumn("_part", F.pmod(F.xxhash64(*others), fact_parts))
        .drop("_parts")
    )
    salted_dim = (
        dim.join(F.broadcast(hot), key, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .drop("_parts")
    )
    return salted_facts.join(salted_dim, [key, "_part"], how).drop("_part")
