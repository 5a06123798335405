"""Exact numbers of different keys, several at once, from one pass.

A whole number is a bit of a 64-bit word: rows are reduced to (label, word
number) with the bits that occurred, and the bits are counted at the end. Words
merge by OR, so tasks reduce before the shuffle, groups can be put together
later, and nothing is multiplied whole as several distinct aggregates in one
select would. Dense keys need a row per 64 of them; scattered keys a row each,
no more than their distinct values would. Keys of several columns keep all but
the last as they are; texts stand for themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def word_of(column: Column) -> Column:
    """Number of the word that holds the bit of a whole number: its 64th, rounded down."""
    return F.shiftright(column.cast("bigint"), 6)


def bit_of(column: Column) -> Column:
    """The word with just the bit of a whole number."""
    place = column.cast("bigint").bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def distinct_counts(df: DataFrame, keys: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by`` and label of ``keys``: label, distinct_values.

    A key of one column is not counted where it is null; of several columns, a
    null is a value. Columns before the last of a key are whole numbers, and so
    is the last unless it is a text. A label without any value has no row.
    """
    types = dict(df.dtypes)
    width = max((len(c) - 1 for c in keys.values()), default=0)

    def entry(label: str, columns: Sequence[str]) -> Column:
        *before, last = [F.col(f"`{c}`") for c in columns]
        text = types[columns[-1]] == "string"
        one = F.lit(1).cast("bigint")
        held = F.struct(
            F.lit(label).alias("label"),
            *[(before[i].cast("bigint") if i < len(before) else F.lit(None).cast("bigint")).alias(f"k{i}") for i in range(width)],
            (F.lit(None).cast("bigint") if text else word_of(last)).alias("word"),
            (last if text else F.lit(None).cast("string")).alias("text"),
            (one if text else F.coalesce(bit_of(last), one)).alias("bits"),
        )
        return held if before else F.when(last.isNotNull(), held)

    entries = df.select(
        *by, F.explode(F.array(*[entry(n, c) for n, c in keys.items()])).alias("e")
    ).where("e IS NOT NULL").select(*by, "e.*")
    words = entries.groupBy(*by, "label", *[f"k{i}" for i in range(width)], "word", "text").agg(
        F.bit_or("bits").alias("bits")
    )
    return words.groupBy(*by, "label").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("distinct_values"))
