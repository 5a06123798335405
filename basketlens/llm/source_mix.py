"""Mixing sources to target weights by pivotal dependent rounding.

Each document should be taken target / source size times. Whole copies are
certain; the fraction left over is decided by pairing: two documents of a
source exchange words at random, in a way that keeps every document's expected
share and the source's words, until one of them has a fraction of 0 or 1. The
other goes on to the next pair. Each task ends with one open document per
source and bucket; these are brought together in a tree, ever more buckets at
a time, until one open document per source is left, which is drawn. So a
source's words miss its target by less than one document.

The draws depend on the seed, source and bucket only, and rows are sorted
before they are paired, so a rerun agrees however Spark lays out the data.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, the last; a source of size 0 has target 0;
repeated rows are decided one by one; an empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import WORD, numbered
from basketlens.sources.staging import Workspace

WEIGHTS = (3, 1, 2)
#: The mix holds this share of all words, in percent; no source is taken more often than MOST times.
SHARE_PERCENT, MOST = 150, 2
#: Documents of a source that one task pairs, and residuals one node of the tree takes.
LEAF, FAN = 50_000, 256
SEED = 20240607

# Source as a key without nulls.
def _source_key():
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def word_count(text: str):
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    rows: DataFrame, space: Workspace, weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT, most: int = MOST,
) -> DataFrame:
    """A row per source of ``rows`` (source, size): n_docs, source_size, target.

    Targets are in proportion to the weights below a common level, and stop at
    ``most`` times the source's size; the level rises until they add up.
    """
    sizes = rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")
    ).withColumn("unnamed", F.col("source").isNull().cast("int"))
    ranked = numbered(sizes, ["unnamed", "source"], space, "sources")
    cycle = F.array(*map(F.lit, weights))
    weighed = space.save(
        ranked.select(
            "source", "n_docs", "source_size",
            F.element_at(cycle, (F.col("position") % len(weights)).cast("int") + 1)
            .cast("bigint").alias("weight"),
        ),
        "weights",
    )
    whole = weighed.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    level = (0, 1)  # words per unit of weight, as a fraction
    while True:
        # Only three sums leave the executors, however many sources there are.
        above = cap.cast("decimal(38,0)") * F.lit(level[1]).cast("decimal(38,0)") <= (
            F.col("weight").cast("decimal(38,0)") * F.lit(level[0]).cast("decimal(38,0)")
        )
        full = (F.col("source_size") == 0) | above
        held, weight = weighed.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        rest = share_percent * whole - 100 * int(held or 0)
        following = (rest, 100 * int(weight)) if weight else level
        if following[0] * level[1] == level[0] * following[1] or not weight:
            break
        level = following
    rate = F.col("weight").cast("double") * float(level[0]) / float(level[1])
    return weighed.select(
        "source", "n_docs", "source_size",
        F.when(full, cap.cast("double")).otherwise(rate).alias("target"),
    )


def _pivot(batches: Iterator[pa.RecordBatch], level: int, seed: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Decide all but one document of each (source key, group), streaming sorted rows.

    The last two columns are ``fraction`` and ``open``; decided rows leave with a
    fraction of 0 or 1 and ``open`` false.
    """
    held: pa.RecordBatch | None = None  # the open document, as one row
    place, p, size, draw = None, 0.0, 0, random.Random(0)

    def closed(rows: pa.RecordBatch, fractions: list[float], still: bool) -> pa.RecordBatch:
        n = rows.num_columns
        return pa.RecordBatch.from_arrays(
            [*rows.columns[: n - 2], pa.array(fractions, pa.float64()), pa.array([still] * len(fractions), pa.bool_())],
            schema=rows.schema,
        )

    def end() -> Iterator[pa.RecordBatch]:
        if held is not None:
            yield closed(held, [float(draw.random() < p) if last else p], not last)

    for batch in batches:
        sources, groups = batch.column("skey").to_pylist(), batch.column("bucket").to_pylist()
        sizes, fractions = batch.column("size").to_pylist(), batch.column("fraction").to_pylist()
        out: list[float | None] = [None] * len(sources)
        at = -1  # row of the open document, if it is in this batch
        for i, (source, group, s, f) in enumerate(zip(sources, groups, sizes, fractions)):
            if (source, group) != place:
                if at >= 0:
                    held = batch.slice(at, 1)
                yield from end()
                if at >= 0:
                    out[at] = None
                held, at, place = None, -1, (source, group)
                draw = random.Random(f"{seed}/{level}/{group}/{source}")
            if s == 0 or f <= 0.0 or f >= 1.0:
                out[i] = 0.0 if s == 0 else f
                continue
            if at < 0 and held is None:
                at, p, size = i, f, s
                continue
            # Words the open document can win from this one, and lose to it.
            win, lose = min((1 - p) * size, f * s), min(p * size, (1 - f) * s)
            if draw.random() * (win + lose) < lose:
                full = (1 - p) * size <= f * s
                first, second = (1.0 if full else p + win / size), (f - win / s if full else 0.0)
            else:
                full = (1 - f) * s <= p * size
                first, second = (p - lose / size if full else 0.0), (1.0 if full else f + lose / s)
            first, second = (min(1.0, max(0.0, round(x, 15))) for x in (first, second))
            if 0.0 < first < 1.0:
                out[i], p = second, first
                continue
            if at >= 0:
                out[at] = first
            else:
                yield closed(held, [first], False)
            held, at = None, -1
            if 0.0 < second < 1.0:
                at, p, size = i, second, s
            else:
                out[i] = second
        if at >= 0:
            held = batch.slice(at, 1)
        decided = [i for i, f in enumerate(out) if f is not None]
        if decided:
            yield closed(batch.take(pa.array(decided)), [out[i] for i in decided], False)
    yield from end()


def mixed(rows: DataFrame, key: str, space: Workspace, leaf: int = LEAF, fan: int = FAN, seed: int = SEED, **how) -> DataFrame:
    """``rows`` (source, size, key and others) with source_size, target and ``copies``."""
    targets = source_targets(rows.select("source", "size"), space, **how).withColumn("skey", _source_key())
    # At most (all rows / leaf) sources are as large as this.
    hot = targets.where(F.col("n_docs") > leaf).select(
        "skey", F.ceil(F.col("n_docs") / F.lit(leaf)).cast("bigint").alias("parts")
    )
    most = hot.agg(F.max("parts")).first()[0] or 1
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    part = F.pmod(F.xxhash64(key, "size"), F.coalesce("parts", F.lit(1)))
    spread = rows.withColumn("skey", _source_key()).join(F.broadcast(hot), "skey", "left").withColumn("bucket", part).drop("parts")
    each = targets.select("skey", "source_size", "target").join(hot, "skey", "left").select(
        "skey", "source_size", "target",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)).alias("bucket"),
    )
    carried = [c for c in rows.columns]
    now = spread.join(each, ["skey", "bucket"]).select(
        *carried, "source_size", "target", F.floor(ratio).alias("whole"), "skey", "bucket",
        F.round(ratio - F.floor(ratio), 15).alias("fraction"), F.lit(True).alias("open"),
    )
    results, level = [], 0
    while True:
        last = most <= 1
        sorted_rows = now.repartition("skey", "bucket").sortWithinPartitions("skey", "bucket", "size", key)
        done = space.save(
            sorted_rows.mapInArrow(
                lambda batches, level=level, last=last: _pivot(batches, level, seed, last), now.schema
            ),
            f"level-{level}",
        )
        results.append(done.where(~F.col("open")))
        if last:
            break
        level, most = level + 1, -(-most // fan)
        now = done.where("open").withColumn("bucket", F.expr(f"bucket div {fan}"))
    decided = results[0]
    for more in results[1:]:
        decided = decided.union(more)
    return decided.withColumn("copies", (F.col("whole") + F.col("fraction")).cast("bigint"))


def mix_report(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """Per row: key, size, source_size, target, taken (words, repeats counted)."""
    space = Workspace(documents.sparkSession, "source-mix")
    rows = space.save(
        documents.select(F.col(key), F.col(source).cast("string").alias("source"), word_count(text).alias("size")), "sizes"
    )
    return mixed(rows, key, space, **how).select(
        key, "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_rows(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns.

    The mix is made of sizes; the documents travel once, to their copies. Rows of
    one key, source and text are alike to it, so each gets one of their numbers.
    """
    space = Workspace(documents.sparkSession, "source-mix")
    name = F.col(source).cast("string")
    same = [
        F.xxhash64(F.col(key), name, F.col(text)).alias("hash"),
        F.xxhash64(F.col(text).isNull(), F.col(text), name.isNull(), F.col(key), F.lit(SEED)).alias("other"),
    ]
    rows = space.save(
        documents.select(*same, F.col(key).alias("row_key"), name.alias("source"), word_count(text).alias("size")), "sizes"
    )
    each = mixed(rows, "row_key", space, **how).groupBy("hash", "other").agg(
        F.sort_array(F.collect_list("copies"), asc=False).alias("copies")
    )
    joined = documents.select(F.struct("*").alias("row"), *same).join(each.where("copies[0] > 0"), ["hash", "other"])
    nth = F.row_number().over(Window.partitionBy("hash", "other").orderBy("hash", "other"))
    taken = joined.withColumn("own", F.element_at("copies", nth)).where("own > 0")
    repeats = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("own")))
    return taken.select("row", repeats.alias("copy")).select("row.*")
