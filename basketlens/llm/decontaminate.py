"""Benchmark passages in documents by Wu-Manber search over words.

The benchmark's windows of 13 words (shorter items whole) are the search
strings. For each string length a shift table tells, from the two words at the
end of the current position, how many positions can be skipped; where it says
none, the strings ending in those two words are taken from a bucket, thinned by
their first two words and compared word by word.

The benchmark is read in blocks of bounded size; each block is one pass over
the documents, and passes follow each other inside the same tasks without a
shuffle, adding to the hits found so far.

Defined cases: a null or empty text has no words and is clean; an item without
words is never found; an item without an id marks words but is not listed;
repeated items count once; repeated documents are judged each; empty tables
give no rows or no hits; all columns of the documents are carried along.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 13
#: Text bytes of the benchmark that one pass searches for.
BLOCK_BYTES = 16 << 20
#: A document with at least one word in this many hit is contaminated.
SHARE = 20

# A to Z lower-cased; every other ASCII character that is no letter or digit is a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Strings:
    """Search strings of one length: shift table and buckets by last and first words."""

    def __init__(self, length: int, strings: dict[tuple[int, ...], set[int]]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for words, items in strings.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            bucket = self.buckets[words[-self.block :]]
            bucket[words[: self.block]].append((list(words), items))

    def find(self, ids: list[int | None]) -> Iterator[tuple[int, set[int]]]:
        """(first word, items) of each place where a string occurs."""
        length, far, shift = self.length, self.far, self.shift
        n, i, pair = len(ids), self.length - 1, self.block == 2
        while i < n:
            block = (ids[i - 1], ids[i]) if pair else (ids[i],)
            skip = shift.get(block, far)
            if skip:
                i += skip
                continue
            start = i - length + 1
            for words, items in self.buckets[block].get(tuple(ids[start : start + self.block]), ()):
                if ids[start : i + 1] == words:
                    yield start, items
            i += 1


class Search:
    """All strings of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
        for item, (_, text) in enumerate(items):
            ids = tuple(
                self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)
            )
            length = min(WINDOW, len(ids))
            for k in range(len(ids) - length + 1 if ids else 0):
                by_length[length][ids[k : k + length]].add(item)
        self.strings = [Strings(length, found) for length, found in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches (first word, end) and names of the items found."""
        ids = list(map(self.vocabulary.get, words))
        stretches, items = [], set()
        for strings in self.strings:
            for start, found in strings.find(ids):
                stretches.append((start, start + strings.length))
                items |= found
        return stretches, {self.names[i] for i in items if self.names[i] is not None}


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def benchmark_blocks(
    benchmark: DataFrame, item: str, text: str, block_bytes: int
) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's items in blocks of about ``block_bytes``, one held at a time."""
    items = benchmark.select(
        F.col(item).cast("string").alias("item"), F.col(text).cast("binary").alias("text")
    ).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield [(r["item"], bytes(r["text"])) for r in mine.collect()]


_FOUND = "n_words bigint, stretches array<int>, items array<string>"


def searched(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row`` (all columns of the document), n_words, hit stretches and names of found items."""
    nothing = F.array().cast("array<int>"), F.array().cast("array<string>")
    found = documents.select(
        F.struct("*").alias("row"), F.lit(0).cast("bigint").alias("n_words"),
        nothing[0].alias("stretches"), nothing[1].alias("items"),
    )
    row_type = found.schema["row"].dataType.simpleString()
    context = documents.sparkSession.sparkContext
    field = documents.columns.index(text)

    def one_pass(known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(known.value)
            for batch in batches:
                n_words, stretches, items = [], [], []
                texts = batch.column(0).field(field).cast(pa.binary()).to_pylist()
                valid = zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist())
                for content, before, names in valid:
                    words = words_of(content)
                    own, more = search.hits(words)
                    if own:
                        own += zip(before[::2], before[1::2])
                        before = np.array(merged(own)).ravel().tolist()
                        names = sorted({*names, *more})
                    n_words.append(len(words))
                    stretches.append(before)
                    items.append(names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_words, pa.int64()), pa.array(stretches, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string()))],
                    ["row", "n_words", "stretches", "items"],
                )

        return run

    for block in benchmark_blocks(benchmark, item, item_text, block_bytes):
        known = context.broadcast(block)  # about block_bytes of text
        found = found.mapInArrow(one_pass(known), f"row {row_type}, {_FOUND}")
    return found


def judged(found: DataFrame) -> DataFrame:
    """Counts and the verdict from the hit stretches."""
    pairs = F.sequence(F.lit(0), F.greatest(F.floor(F.size("stretches") / 2) - 1, F.lit(0)))
    length = lambda k: F.coalesce(
        F.get("stretches", (2 * k + 1).cast("int")) - F.get("stretches", (2 * k).cast("int")), F.lit(0)
    )
    n_hit = F.aggregate(pairs, F.lit(0).cast("bigint"), lambda total, k: total + length(k))
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = judged(searched(documents.select(key, text), benchmark, text, item, "text", block_bytes))
    return found.select(
        F.col(f"row.`{key}`").alias(key), "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_rows(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return judged(searched(documents, benchmark, text)).where(~F.col("contaminated")).select("row.*")
