"""Token counts of documents from counts of their distinct pre-tokens.

Every distinct pre-token of the corpus is tokenized once, in a table with its
number of pieces. Each document then needs only how often it holds each
pre-token: the frequencies are joined to the table and summed, and no id list
of a document is ever made. The commonest pre-tokens, a fixed number of short
ones, are joined from a broadcast where the text is read; only the rare rest is
shuffled, in which no key is hot.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows
are counted each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.pretokens import Units, slices
from basketlens.sources.staging import Workspace

#: Commonest units that are broadcast, and the longest unit among them: at most 8 MB.
HEAD, HEAD_CHARS = 200_000, 16
#: Texts that are split together, by number and bytes.
SPLIT_ROWS, SPLIT_BYTES = 8_192, 6 << 20
#: Units that a task counts before it passes them on.
HELD = 1_000_000
OUT_ROWS = 50_000
LIMIT = 2_048


def unit_counts(texts: DataFrame, vocabulary: str) -> DataFrame:
    """(unit, n) of a one-column frame of texts: how often each unit occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units.opened(vocabulary)
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("unit").aggregate([("n", "sum")]).rename_columns(["unit", "n"])

        for batch in batches:
            column = batch.column(0).cast(pa.string()).fill_null("")
            for first, size in slices(column, SPLIT_ROWS, SPLIT_BYTES):
                for _, codes, _, names in units.column_units(column.slice(first, size)):
                    n = np.bincount(codes.to_numpy(zero_copy_only=False), minlength=len(names))
                    held.append(pa.table({"unit": names, "n": pa.array(n, pa.int64())}))
                if sum(map(len, held)) > HELD:
                    held = [summed()]
                    if len(held[0]) > HELD // 2:
                        yield from held.pop().to_batches(OUT_ROWS)
        if held:
            yield from summed().to_batches(OUT_ROWS)

    return texts.mapInArrow(count, "unit string, n bigint").groupBy("unit").agg(F.sum("n").alias("n"))


def with_pieces(counts: DataFrame, vocabulary: str) -> DataFrame:
    """Add the number of ids that the library gives for each unit."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units.opened(vocabulary)
        width = units.dtype.itemsize
        for batch in batches:
            names = batch.column(0).to_pylist()
            splits = [units.split(x.encode()) for x in names]
            lengths = [0] * len(names)
            whole = [i for i, s in enumerate(splits) if s != [names[i]]]
            plain = [i for i, s in enumerate(splits) if s == [names[i]]]
            for i, ids in zip(plain, units.encode_pretokens([names[i] for i in plain])):
                lengths[i] = len(ids) // width
            for i in whole:
                lengths[i] = len(units.encode_whole(names[i].encode())) // width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths, pa.int64())], ["unit", "n", "pieces"]
            )

    return counts.mapInArrow(pieces, "unit string, n bigint, pieces bigint")


def token_counts(
    documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
    limit: int = LIMIT, head: int = HEAD,
) -> DataFrame:
    """Per row: key, n_bytes, n_tokens, over_limit."""
    space = Workspace(documents.sparkSession, "token-counts")
    texts = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    table = space.save(with_pieces(unit_counts(texts.select("text"), vocabulary), vocabulary), "pieces")
    # Written first: collecting a sorted limit would bring each task's own head along.
    common = space.save(
        table.where(F.length("unit") <= HEAD_CHARS)
        .orderBy(F.desc("n"), "unit").limit(head).select("unit", "pieces"),
        "common",
    ).toPandas()
    known = documents.sparkSession.sparkContext.broadcast(
        (common["unit"].tolist(), common["pieces"].to_numpy(np.int64))
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document with the pieces that are known, and one per rarer unit in it."""
        units = Units.opened(vocabulary)
        head_units = pa.array(known.value[0], pa.string())
        head_pieces = np.append(known.value[1], 0)
        for batch in batches:
            column = batch.column(2).cast(pa.string()).fill_null("")
            for first, size in slices(column, SPLIT_ROWS, SPLIT_BYTES):
                part = batch.slice(first, size)
                row = part.column(0).to_numpy()
                total = np.zeros(size, np.int64)
                for rows, codes, starts, names in units.column_units(column.slice(first, size)):
                    at = pc.fill_null(pc.index_in(names, head_units), len(head_units)).to_numpy()
                    own = codes.to_numpy(zero_copy_only=False)
                    sums = np.concatenate([[0], np.cumsum(head_pieces[at][own])])
                    total[rows] = np.diff(sums[starts])
                    rare = np.flatnonzero((at == len(head_units))[own])
                    holder = np.searchsorted(starts, rare, "right") - 1
                    both, n = np.unique(holder * len(names) + own[rare], return_counts=True)
                    yield _batch(
                        row[rows[both // max(1, len(names))]], None,
                        names.take(pa.array(both % max(1, len(names)))), n, None,
                    )
                yield _batch(row, part.column(1), None, total, pc.binary_length(column.slice(first, size)))

    def _batch(row, key_, unit, n, n_bytes) -> pa.RecordBatch:
        def column(values, kind):
            return pa.nulls(len(row), kind) if values is None else values

        return pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), column(key_, pa.int64()), column(unit, pa.string()),
             pa.array(n, pa.int64()), column(n_bytes, pa.int64()).cast(pa.int64())],
            ["row", "key", "unit", "n", "n_bytes"],
        )

    # The scan gives a row the same number when a task runs again.
    found = texts.select(F.monotonically_increasing_id().alias("row"), "key", "text").mapInArrow(
        frequencies, "row bigint, key bigint, unit string, n bigint, n_bytes bigint"
    )
    # A document's own row joins nothing; its row number spreads those rows.
    own = F.concat(F.lit("\n"), F.col("row").cast("string"))
    joined = found.withColumn("unit", F.coalesce("unit", own)).join(
        table.select("unit", "pieces").hint("shuffle_merge"), "unit", "left"
    )
    summed = joined.groupBy("row").agg(
        F.max("key").alias(key),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
    )
    return summed.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
