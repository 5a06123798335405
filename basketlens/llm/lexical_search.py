"""Ranked lexical search with a K2-treap over the grid of terms and documents.

A block of documents and the terms of the queries span a grid; a cell holds the
impact of its term in its document. The grid is kept as a quadtree of its
non-empty cells: per node four bits for the children that exist, and the largest
impact below it, stored as the distance to its parent's in as few bytes as the
level needs. Terms stand by weight, so terms that share a cell weigh alike.

A query descends all its terms' row paths jointly: a document range knows for
each term the cell that holds the term's row over the range, and the sum of the
cells' maxima bounds every document in it. The ranges with the highest bounds are
halved first, and a range is left when its bound can't reach the ten best so far,
which a task carries from block to block. Single documents have exact scores.

Queries are taken in blocks of bounded size, each against all documents: one pass
keeps the documents' terms that the block asks for, with which the counts over
all documents are made, one builds the trees, one searches them. A document's
other terms can't change a result and are counted only.

Defined cases: a null or empty text has no terms; an item without terms, or whose
terms are in no document or in all, has no rows; rows that repeat an item's id
are one item with the terms of all, and so are rows without an id; repeated
documents are ranked each; equal scores stand by key, null first; fewer than ten
scores above 0 give fewer rows; empty tables give none. Keys of documents are
integers. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import numbered
from basketlens.llm.decontaminate import words_of
from basketlens.sources.staging import Workspace

TOP = 10
#: A block of queries: items at most, and terms from which on another block begins.
BLOCK_ITEMS, BLOCK_TERMS = 1_024, 65_536
#: A block of documents: rows at most, and cells from which on another block begins.
BLOCK_DOCS, BLOCK_CELLS = 4_096, 1 << 20
#: Ranges that are halved together, and nodes that those and the waiting ranges may hold.
BATCH, BATCH_NODES, WAITING_NODES = 64, 1 << 18, 1 << 23

_ONES = np.array([bin(x).count("1") for x in range(16)], np.int64)
_NO_KEY = np.iinfo(np.int64).min

_GRID = "key bigint, n bigint, terms array<int>, counts array<int>"
_INDEX = "keys array<bigint>, height int, sizes array<int>, widths array<int>, children binary, maxima binary"


# -- the tree -------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Put a zero before every bit of 32."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass
class Packed:
    """A tree as it is stored: levels from the root, one after the other."""

    height: int
    sizes: list[int]
    widths: list[int]
    children: bytes
    maxima: bytes


def packed(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Packed:
    """The tree of the cells (row, column) with impacts above 0; no cell twice."""
    height = max(1, int(max(rows.max(), columns.max())).bit_length())
    place = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(place, kind="stable")
    place, highest = place[order], impacts[order]
    sizes, widths, bits, steps = [], [], [], []
    below_digit, below_max = None, None
    for _ in range(height + 1):
        # ``place`` has a row per node of the level here, ``highest`` its maximum.
        sizes.append(len(place))
        below_digit, below_max = (place & np.uint64(3)).astype(np.int64), highest
        up = place >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
        above = np.maximum.reduceat(highest, first)
        if len(sizes) <= height:
            bits.append(np.bitwise_or.reduceat(1 << below_digit, first).astype(np.uint8))
            owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(up))))
            step = above[owner] - below_max
        else:
            step = below_max
        width = max(1, (int(step.max()).bit_length() + 7) // 8)
        widths.append(width)
        steps.append(step.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
        place, highest = up[first], above
    return Packed(height, sizes[::-1], widths[::-1], b"".join(b.tobytes() for b in bits[::-1]), b"".join(steps[::-1]))


class Tree:
    """A stored tree, opened: nodes of all levels in one numbering, the root being 0."""

    def __init__(self, stored: Packed):
        self.height = stored.height
        inner = sum(stored.sizes[:-1])
        self.bits = np.zeros(sum(stored.sizes), np.int64)
        self.bits[:inner] = np.frombuffer(stored.children, np.uint8)
        children = _ONES[self.bits]
        self.first = 1 + np.cumsum(children) - children
        self.highest = np.empty(len(self.bits), np.int64)
        parent = np.repeat(np.arange(inner), children[:inner])
        at, node = 0, 0
        for size, width in zip(stored.sizes, stored.widths):
            step = np.zeros((size, 8), np.uint8)
            step[:, :width] = np.frombuffer(stored.maxima, np.uint8, size * width, at).reshape(size, width)
            value = step.view("<i8").reshape(size)
            self.highest[node : node + size] = self.highest[parent[node - 1 : node - 1 + size]] - value if node else value
            at, node = at + size * width, node + size


class Best:
    """The highest scores of an item so far, by (score, smaller key)."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.keys = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.concatenate([self.scores, scores]), np.concatenate([self.keys, keys])
        order = np.lexsort((keys, -scores))[: self.k]
        self.scores, self.keys = scores[order], keys[order]

    def hopeful(self, bounds: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether a document of this score at most, and this key at least, could still enter."""
        if len(self.scores) < self.k:
            return bounds > 0
        return (bounds > self.scores[-1]) | ((bounds == self.scores[-1]) & (keys < self.keys[-1]))


def searched(tree: Tree, rows: np.ndarray, keys: np.ndarray, best: Best) -> int:
    """Add the block's documents that belong to ``best``; the number of ranges halved.

    ``keys`` ascend. A range is a level, a first column, a bound and a node per
    row (-1 where the range holds nothing of the row).
    """
    height = tree.height
    level, start = np.zeros(1, np.int64), np.zeros(1, np.int64)
    node = np.zeros((1, len(rows)), np.int64)
    bound = np.array([tree.highest[0] * len(rows)])
    batch = max(1, min(BATCH, BATCH_NODES // len(rows)))
    halved = 0
    while len(bound):
        if len(bound) > batch:
            # With very long queries the smallest ranges go first where too many wait.
            first_come = -bound if node.size < WAITING_NODES else -level
            chosen = np.argpartition(first_come, batch - 1)
            now, later = chosen[:batch], chosen[batch:]
        else:
            now, later = np.arange(len(bound)), np.zeros(0, np.int64)
        halved += len(now)
        at, down = node[now], level[now]
        exists, at = at >= 0, np.maximum(at, 0)
        bits, first = tree.bits[at], tree.first[at]
        row_bit = (rows >> (height - 1 - down)[:, None]) & 1
        parts = []
        for half in (0, 1):
            digit = 2 * row_bit + half
            here = exists & ((bits >> digit) & 1 == 1)
            child = np.where(here, first + _ONES[bits & ((1 << digit) - 1)], -1)
            total = np.where(here, tree.highest[child], 0).sum(axis=1)
            left = start[now] + half * (1 << (height - 1 - down))
            parts.append((down + 1, left, child, total))
        new_level, left, child, total = (np.concatenate(x) for x in zip(*parts))
        held = left < len(keys)
        new_level, left, child, total = new_level[held], left[held], child[held], total[held]
        done = (new_level == height) & (total > 0)
        if done.any():
            best.add(total[done], keys[left[done]])
        level = np.concatenate([level[later], new_level])
        start = np.concatenate([start[later], left])
        node = np.concatenate([node[later], child])
        bound = np.concatenate([bound[later], total])
        stay = (level < height) & best.hopeful(bound, keys[start])
        level, start, node, bound = level[stay], start[stay], node[stay], bound[stay]
    return halved


# -- queries ----------------------------------------------------------------------


def item_terms(items: DataFrame, item: str, text: str, space: Workspace) -> DataFrame:
    """(item, terms, position, block, part) of the items that have terms."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            terms = [sorted({w.decode("utf-8", "replace") for w in words_of(t)}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item", "terms"]
            )

    kind = items.schema[item].dataType.simpleString()
    single = items.select(F.col(item).alias("item"), F.col(text).alias("text")).mapInArrow(
        split, f"item {kind}, terms array<string>"
    )
    # Rows of an item may be many, its different terms are what the search holds anyway.
    whole = single.select("item", F.explode("terms").alias("term")).distinct().groupBy("item").agg(
        F.sort_array(F.collect_list("term")).alias("terms")
    )
    placed = numbered(whole, ["item"], space, "items").withColumn("block", F.expr(f"position div {BLOCK_ITEMS}"))
    before = F.sum(F.size("terms")).over(
        Window.partitionBy("block").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("part", (F.coalesce(before, F.lit(0)) / BLOCK_TERMS).cast("int"))


# -- passes over the documents ------------------------------------------------------


def grid(documents: DataFrame, key: str, text: str, terms: Sequence[str]) -> DataFrame:
    """Per document: its number of terms, and which of ``terms`` it holds how often."""
    asked = documents.sparkSession.sparkContext.broadcast([t.encode() for t in terms])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {t: i for i, t in enumerate(asked.value)}.get
        for batch in batches:
            lengths, found, counts = [], [], []
            for value in batch.column(1):
                # One text at a time: bytes, words and hits of a single document.
                words = words_of(value.as_buffer().to_pybytes() if value.is_valid else None)
                hits = [i for i in map(get, words) if i is not None]
                ids, n = np.unique(np.array(hits, np.int32), return_counts=True)
                lengths.append(len(words))
                found.append(ids)
                counts.append(n.astype(np.int32))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(found, kind), pa.array(counts, kind)],
                ["key", "n", "terms", "counts"],
            )

    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(counted, _GRID)


@dataclass
class Weights:
    """Counts over all documents, and the place and weight of each term."""

    documents: int
    terms: int
    #: Row of the tree by position in the list of terms; weight by row.
    row: np.ndarray
    weight: np.ndarray


def weighted(held: DataFrame, n_terms: int) -> Weights:
    """Weights of the terms; one row a term of the block comes to the driver."""
    total = held.agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")
    ).first()
    found = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    frequency = np.zeros(n_terms, np.int64)
    for r in found:
        frequency[r["term"]] = r["n"]
    n = total["documents"]
    weight = np.array(
        [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) if df else 0 for df in frequency.tolist()], np.int64
    )
    order = np.argsort(-weight, kind="stable")
    row = np.empty(n_terms, np.int64)
    row[order] = np.arange(n_terms)
    return Weights(n, total["terms"], row, weight[order])


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, counts: Weights) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers."""
    m = 100 - 90 + (90 * n * counts.documents) // counts.terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def trees(held: DataFrame, counts: Weights) -> DataFrame:
    """A stored tree per block of documents, with the documents' keys in order."""
    known = held.sparkSession.sparkContext.broadcast(
        (counts.documents, counts.terms, counts.row, counts.weight)
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(*known.value)

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            table = pa.Table.from_batches(parts)
            key, n, terms, tfs = (c.combine_chunks() for c in table.columns)
            order = np.argsort(key.fill_null(_NO_KEY).to_numpy(), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            sizes = np.diff(terms.offsets.to_numpy())
            holder = np.repeat(np.arange(len(sizes)), sizes)
            rows = weights.row[terms.flatten().to_numpy()]
            value = impacts(
                weights.weight[rows], tfs.flatten().to_numpy().astype(np.int64), n.to_numpy()[holder], weights
            )
            some = value > 0
            if not some.any():
                return None
            tree = packed(rows[some], place[holder[some]], value[some])
            columns = (
                (key.take(pa.array(order)), pa.list_(pa.int64())), (tree.height, pa.int32()),
                (tree.sizes, pa.list_(pa.int32())), (tree.widths, pa.list_(pa.int32())),
                (tree.children, pa.binary()), (tree.maxima, pa.binary()),
            )
            return pa.RecordBatch.from_arrays(
                [pa.array([v.to_pylist() if isinstance(v, pa.Array) else v], t) for v, t in columns],
                ["keys", "height", "sizes", "widths", "children", "maxima"],
            )

        waiting: list[pa.RecordBatch] = []
        docs = cells = 0
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_DOCS // 8):
                part = whole.slice(first, BLOCK_DOCS // 8)
                waiting.append(part)
                docs += part.num_rows
                cells += len(part.column(2).flatten())
                if docs > BLOCK_DOCS - BLOCK_DOCS // 8 or cells >= BLOCK_CELLS:
                    if (made := block(waiting)) is not None:
                        yield made
                    waiting, docs, cells = [], 0, 0
        if waiting and (made := block(waiting)) is not None:
            yield made

    return held.where(F.size("terms") > 0).mapInArrow(build, _INDEX)


def hits(index: DataFrame, queries: Sequence[Sequence[int]], counts: Weights, k: int = TOP) -> DataFrame:
    """(query, key, score): for each query the best documents of each task."""
    rows = [sorted(r for r in counts.row[list(q)].tolist() if counts.weight[r] > 0) for q in queries]
    asked = index.sparkSession.sparkContext.broadcast([np.array(r, np.int64) for r in rows])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked.value]
        for batch in batches:
            for stored in batch.to_pylist():
                tree = Tree(Packed(*(stored[c] for c in ("height", "sizes", "widths", "children", "maxima"))))
                keys = np.array([_NO_KEY if x is None else x for x in stored["keys"]], np.int64)
                for query, found in zip(asked.value, best):
                    if len(query) and query[0] < 1 << tree.height:
                        searched(tree, query[query < 1 << tree.height], keys, found)
        sizes = [len(b.scores) for b in best]
        key = np.concatenate([b.keys for b in best]) if best else np.zeros(0, np.int64)
        score = np.concatenate([b.scores for b in best]) if best else key
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()),
             pa.array(key, pa.int64(), mask=key == _NO_KEY), pa.array(score, pa.int64())],
            ["query", "key", "score"],
        )

    return index.mapInArrow(search, "query bigint, key bigint, score bigint")


def ranked_documents(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", k: int = TOP,
) -> DataFrame:
    """Per item and rank: item, rank, key, score; rank 1 is the highest."""
    spark = documents.sparkSession
    space = Workspace(spark, "lexical")
    asked = space.save(item_terms(items, item, item_text, space), "queries")
    kind = items.schema[item].dataType.simpleString()
    result = spark.createDataFrame([], f"item {kind}, key bigint, score bigint")
    blocks = sorted(map(tuple, asked.select("block", "part").distinct().collect()))
    for number, (block, part) in enumerate(blocks):
        mine = asked.where((F.col("block") == block) & (F.col("part") == part))
        queries = mine.select("position", "terms").orderBy("position").collect()
        terms = sorted({t for q in queries for t in q["terms"]})
        place = {t: i for i, t in enumerate(terms)}
        held = space.save(grid(documents, key, text, terms), f"grid-{number}")
        counts = weighted(held, len(terms))
        if not counts.terms:
            break
        index = space.save(trees(held, counts), f"index-{number}")
        found = hits(index, [[place[t] for t in q["terms"]] for q in queries], counts, k)
        # Positions of a block's items follow each other.
        owner = mine.select("item", (F.col("position") - queries[0]["position"]).alias("query"))
        result = result.unionAll(
            space.save(found.join(owner, "query").select("item", "key", "score"), f"hits-{number}")
        )
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("key")))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("item").alias(item), "rank", F.col("key").alias(key), "score"
    )
