"""Pieces that several operators share; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.sources.staging import Workspace

#: ASCII white space; a word is a run of anything else.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of a batch that Python tasks get at once; Spark's own default is 64 MB,
#: which with growing buffers on both sides is several hundred MB an executor.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the batches of a session that has no bound of its own."""
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    return spark


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy a named column into every place that uses it, also
    into lambdas; a lambda's own argument it can't.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def count_upto(n: Column) -> Column:
    """1 to n as an array; empty for n < 1, where sequence() would count down."""
    return F.when(n < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), n))


def numbered(rows: DataFrame, order: Sequence[str], space: Workspace, name: str) -> DataFrame:
    """Add ``position`` (0, 1, ... in ``order``) and ``total``, with no global sort task.

    Rows are dealt into ranges and written with the number of their range and
    their place in it, so both stay as they are when a task runs again, and whole
    rows travel once. The table of range sizes has a row per range; only that is
    summed in one place. ``order`` should end in columns that tell rows apart, else
    a run of equal rows is one range.
    """
    # The number of a row is its partition's, shifted by 33 bits, and its own there.
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_id", F.monotonically_increasing_id()
    )
    saved = space.save(ranged, name).withColumns({
        "_range": F.shiftright("_id", 33), "_inside": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = saved.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("total"),
    )
    return (
        saved.join(F.broadcast(starts), "_range")  # one row per shuffle partition
        .withColumn("position", F.col("_before") + F.col("_inside"))
        .drop("_id", "_range", "_inside", "_before")
    )


def ranges_of(order: DataFrame, most: int) -> Column:
    """Cuts of the rows numbered in ``position`` and ``total`` into at most ``most`` ranges of like size.

    An array of the first row of each range but the lowest, as one value; the
    other columns of ``order`` say what rows are told apart by.
    """
    cells = [c for c in order.columns if c not in ("position", "total")]
    step = F.expr(f"(total + {most - 1}) div {most}")
    return order.where((F.col("position") > 0) & (F.col("position") % step == 0)).agg(
        F.sort_array(F.collect_set(F.struct(*cells))).alias("cuts")
    ).scalar()


def range_of(row: Column, cuts: Column, most: int) -> Column:
    """How many of the sorted ``cuts``, fewer than ``most``, are not above the row; equal rows agree."""
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])

    def search(both: Column) -> Column:
        def closer(at: Column, half: Column) -> Column:
            found = (at + half <= F.size(both["cuts"])) & (F.get(both["cuts"], at + half - 1) <= both["row"])
            return F.when(found, at + half).otherwise(at)

        return F.aggregate(halves, F.lit(0), closer)

    return let(F.struct(row.alias("row"), cuts.alias("cuts")), search)
