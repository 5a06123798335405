"""CSV records with line breaks in quoted cells, read by as many tasks as a file has splits.

A line break ends a record if the number of quotes before it is even, doubled
quotes included. Every split counts its quotes as if it began outside a cell; a
prefix sum of the parities, one row per split, tells which splits really begin
inside one, and so which lines begin a record. Lines that are a record by
themselves go on as they are. The others are put together by the split and number
of the record they belong to, which for the first lines of a split may be the
last record of a split before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_UNCLOSED = "a quoted cell is not closed within a whole split of the file"


def quoted_lines(spark: SparkSession, path: str, latin_1: bool = False) -> DataFrame:
    """(file, start, line, value, odd): the lines of the files, with their split and place."""
    value = F.col("value")
    if latin_1:
        value = F.decode(value.cast("binary"), "ISO-8859-1")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        # Lines of a split are read one after the other.
        F.monotonically_increasing_id().alias("line"), value.alias("value"),
    )
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.withColumn("odd", quotes % 2)


def _relative(lines: DataFrame) -> DataFrame:
    """Add ``seen``: parity of the quotes of the split before the line."""
    before = Window.partitionBy("file", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("seen", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)


def split_states(lines: DataFrame) -> DataFrame:
    """Per split: whether it begins inside a cell, and the record that is open there.

    A row per split of the file; only those pass through one window.
    """
    counted = _relative(lines.drop("value")).groupBy("file", "start").agg(
        (F.sum("odd") % 2).alias("parity"),
        F.count(F.when(F.col("seen") == 0, 1)).alias("if_outside"),
        F.count(F.when(F.col("seen") == 1, 1)).alias("if_inside"),
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = counted.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    begun = opened.withColumn("records", F.when(F.col("inside") == 1, F.col("if_inside")).otherwise(F.col("if_outside")))
    last = F.struct(F.col("start").alias("at"), F.col("records").alias("number"))
    return begun.select(
        "file", "start", "inside",
        F.last(F.when(F.col("records") > 0, last), ignorenulls=True).over(before).alias("open"),
        # Such a split would belong to one record as a whole, which grows without bound.
        ((F.col("inside") == 1) & (F.col("records") == 0) & (F.col("parity") == 0)).alias("lost"),
    )


def quoted_records(spark: SparkSession, path: str, latin_1: bool = False) -> DataFrame:
    """(record, first): every record as text without its end, and whether it is its file's first; in no order.

    Breaks inside a cell are single line feeds. Blank lines between records are
    left out, as is the mark of the byte order. A cell that is still open at the
    end of a whole split is an error.
    """
    lines = quoted_lines(spark, path, latin_1)
    known = _relative(lines).join(split_states(lines), ["file", "start"])
    inside = (F.col("seen") + F.col("inside")) % 2
    begins = F.when(inside == 0, 1).otherwise(0)
    upto = Window.partitionBy("file", "start").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    placed = known.withColumn("begins", begins).withColumn("number", F.sum("begins").over(upto)).select(
        "file",
        F.when(F.col("number") > 0, F.col("start")).otherwise(F.col("open.at")).alias("at"),
        F.when(F.col("number") > 0, F.col("number")).otherwise(F.col("open.number")).alias("number"),
        "start", "line",
        F.when(F.col("lost"), F.raise_error(F.lit(_UNCLOSED))).otherwise(_without_end(F.col("value"))).alias("value"),
        ((F.col("begins") == 1) & (F.col("odd") == 0)).alias("whole"),
    )
    first = (F.col("at") == 0) & (F.col("number") == 1)
    alone = placed.where("whole").where("value <> ''").select(F.col("value").alias("record"), first.alias("first"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("start", "line", "value"))), lambda p: p["value"])
    broken = placed.where("NOT whole").groupBy("file", "at", "number").agg(F.array_join(parts, "\n").alias("record"))
    together = broken.select("record", first.alias("first")).unionByName(alone)
    mark = "ï»¿" if latin_1 else "﻿"
    return together.withColumn("record", F.when(F.col("first"), F.ltrim("record", F.lit(mark))).otherwise(F.col("record")))


def _without_end(value: Column) -> Column:
    return F.regexp_replace(value, "\r$", "")


def quoted_cells(spark: SparkSession, path: str, names: list[str], broken: str, latin_1: bool = False) -> DataFrame:
    """The cells of every record as text, and ``broken`` for records of another width.

    The first record of every file must carry ``names``.
    """
    options = {"escape": '"', "header": "false", "columnNameOfCorruptRecord": broken}
    texts = ", ".join(f"`{c}` STRING" for c in [*names, broken])
    records = quoted_records(spark, path, latin_1)
    cells = records.select("first", F.from_csv("record", texts, options).alias("r"))
    expected = F.array(*map(F.lit, names))
    given = F.array(*[F.coalesce(F.col(f"r.`{n}`"), F.lit("")) for n in names])
    refused = F.raise_error(F.concat(F.lit("CSV header is not the expected one: "), F.array_join(given, ",")))
    header = F.when((given == expected) & F.col(f"r.`{broken}`").isNull(), F.lit(False)).otherwise(refused.cast("boolean"))
    return cells.where(F.when(F.col("first"), header).otherwise(F.lit(True))).select("r.*")
