"""Shards along a Hilbert curve through the documents' metadata.

Source, language and size are quantised to 32 levels each; the Hilbert index
of the cell orders the documents, so neighbours on the curve agree in most
dimensions and a run of the curve touches few cells. The order is cut into
runs of equal row counts. Per-shard minima and maxima of the dimensions then
let a reader skip shards.

Defined cases: a null text has one byte of size (the end mark) and the CRC of
nothing; null source or language take level 0; equal index, key and text keep
any order among themselves; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.common import let, numbered, range_of, ranges_of
from basketlens.sources.staging import Workspace

BITS = 5  # levels per dimension: 32
SHARDS = 8


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Rank and next state for each (state, corner) of the Hilbert curve.

    A state is how a sub-cube lies: entry corner and exit axis, as
    ``entry * dims + axis``. The sub-cubes follow each other in Gray code
    order, turned into the state (Hamilton's form of the curve).
    """
    corners, mask = 1 << dims, (1 << dims) - 1
    gray = [i ^ (i >> 1) for i in range(corners)]
    rank_of = {code: i for i, code in enumerate(gray)}

    def turned(value: int, by: int) -> int:
        by %= dims
        return ((value << by) | (value >> (dims - by))) & mask

    def entry_of(rank: int) -> int:
        return gray[2 * ((rank - 1) // 2)] if rank else 0

    def axis_of(rank: int) -> int:
        odd = rank if rank % 2 else rank - 1
        ones = ((odd + 1) & -(odd + 1)).bit_length() - 1
        return ones % dims if rank else 0

    ranks, nexts = [], []
    for state in range(corners * dims):
        entry, axis = divmod(state, dims)
        for corner in range(corners):
            rank = rank_of[turned(corner ^ entry, -(axis + 1))]
            ranks.append(rank)
            inner = entry ^ turned(entry_of(rank), axis + 1)
            nexts.append(inner * dims + (axis + axis_of(rank) + 1) % dims)
    return ranks, nexts


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a cell given by one level per dimension."""
    dims = len(levels)
    ranks, nexts = (F.array(*map(F.lit, table)) for table in curve_tables(dims))

    def corners(cell: Column) -> Column:
        return F.array(*[
            sum(
                (F.shiftright(cell[f"d{d}"], bit).bitwiseAND(F.lit(1)) * (1 << d) for d in range(dims)),
                F.lit(0),
            )
            for bit in range(bits - 1, -1, -1)
        ])

    def step(seen: Column, corner: Column) -> Column:
        at = seen["state"] * (1 << dims) + corner + 1
        return F.struct(
            F.element_at(nexts, at).alias("state"),
            (seen["index"] * (1 << dims) + F.element_at(ranks, at)).cast("bigint").alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("index"))
    cell = F.struct(*[level.cast("int").alias(f"d{d}") for d, level in enumerate(levels)])
    return let(
        cell, lambda c: F.aggregate(corners(c), start, step, lambda seen: seen["index"])
    )


def _bucket(name: Column) -> Column:
    """Level of a name: null 0, else 1 to 31 by hash."""
    top = (1 << BITS) - 1
    return F.when(name.isNull(), 0).otherwise(F.pmod(F.xxhash64(name), F.lit(top)).cast("int") + 1)


def _magnitude(size: Column) -> Column:
    """Level of a size: two levels for each doubling."""
    top = (1 << BITS) - 1
    return F.least(F.lit(top), F.floor(2 * F.log2(size.cast("double"))).cast("int"))


def curve_columns(documents: DataFrame, text: str, source: str, lang: str) -> list[Column]:
    """``size``, ``text_crc32`` and ``curve`` of each row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(whole).cast("bigint") + 1
    levels = [_bucket(F.col(source)), _bucket(F.col(lang)), _magnitude(size)]
    return [
        size.alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        hilbert_index(levels).alias("curve"),
    ]


def cut_runs(numbered_rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``shard`` and ``slot`` from ``position`` and ``total``; counts at most one apart."""
    shard = F.expr(f"(position * {shards}) div total")
    first = F.expr(f"((position * {shards}) div total * total + {shards - 1}) div {shards}")
    return numbered_rows.withColumn("shard", shard.cast("int")).withColumn(
        "slot", (F.col("position") - first).cast("bigint")
    )


def sharded(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    lang: str = "lang", shards: int = SHARDS,
) -> DataFrame:
    """Shard and slot of every row: key, size, text_crc32, curve, shard, slot."""
    space = Workspace(documents.sparkSession, "hilbert-shards")
    rows = documents.select(F.col(key), *curve_columns(documents, text, source, lang))
    ranked = numbered(rows, ["curve", key, "text_crc32", "size"], space, "curve")
    return cut_runs(ranked, shards).drop("position", "total")


def range_count(spark: SparkSession) -> int:
    """Ranges that whole rows are dealt into: as many as the session's shuffles have partitions at first."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or spark.conf.get("spark.sql.shuffle.partitions"))


def sharded_rows(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    lang: str = "lang", shards: int = SHARDS,
) -> DataFrame:
    """The rows themselves in curve order with ``shard`` and ``slot`` added.

    A column of the input with one of these names is kept under ``in_<name>``. Only
    the rows' places on the curve are staged, so ``documents`` is read more than
    once and should be a stored table.
    """
    spark = documents.sparkSession
    space = Workspace(spark, "hilbert-rows")
    order = ["curve", "_key", "text_crc32", "size"]
    placed = [F.col(key).alias("_key"), *curve_columns(documents, text, source, lang)]
    # The curve alone is numbered and cut into ranges of like size; a run of equal rows is in one.
    thin = numbered(documents.select(*placed), order, space, "curve")
    most = range_count(spark)
    cuts = ranges_of(thin.select(*order, "position", "total"), most)

    def ranged(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_cuts", cuts).withColumn(
            "_range", range_of(F.struct(*order), F.col("_cuts"), most)
        ).drop("_cuts")

    starts = ranged(thin).groupBy("_range").agg(F.min("position").alias("_before"), F.max("total").alias("total"))
    starts = space.save(starts, "starts")
    # Whole rows travel once, a range to a partition, and get their numbers where they arrive.
    whole = ranged(documents.select(F.struct("*").alias("row"), *placed)).repartitionById(most, F.col("_range"))
    counted = whole.sortWithinPartitions(*order).withColumn(
        "_inside", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    placed_rows = counted.join(F.broadcast(starts), "_range").withColumn(
        "position", F.col("_before") + F.col("_inside")
    )
    ranked = cut_runs(placed_rows, shards)
    own = [
        F.col(f"row.`{c}`").alias(f"in_{c}" if c in ("shard", "slot") else c)
        for c in documents.columns
    ]
    return ranked.select(*own, "shard", "slot")


def shard_ranges(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Smallest and largest value of each dimension per shard, for skipping shards."""
    return rows.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[f(d).alias(f"{n}_{d}") for d in dims for f, n in ((F.min, "min"), (F.max, "max"))],
    )
