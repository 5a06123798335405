"""Similarity classes of documents by an exact grouped prefix join.

A document's set holds the hashes of its distinct 4-word shingles. With one
order of shingles for all documents, two sets of Jaccard similarity t or more
share a shingle among their first n - ceil(t n) + 1; rare shingles come first in
that order, and the commonest last.

1. Documents with equal sets form a class; classes of equal size and prefix form
   a group. Only groups take part in the search.
2. Groups that share a prefix shingle become pairs if their sizes and the
   shingle's positions still allow the similarity.
3. Pairs are expanded to their classes; a bitmap of each set bounds the overlap
   from above, and what passes is verified on whole sets.

Links are wanted only as far as they connect, so step 2 first pairs each group
with two pivots per shingle, then groups not yet known to be connected with each
other, all of them. No pair that could join two components is left out, and the members of a large group of near
copies that are soon connected cost pairs in proportion to their number.

Shingles are 64-bit hashes and classes 128-bit digests of the sorted hashes.

Defined cases: null, empty or blank texts have empty sets and are linked with
nothing; texts under 4 words are one shingle; equal rows are one class; a null
key never becomes a component's id unless all its members are null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.components import components
from basketlens.llm.pretokens import worker_store
from basketlens.sources.staging import Workspace

SHINGLE = 4
#: Two documents link when 100 * common >= PERCENT * all.
PERCENT = 85
#: Shingles whose count orders them after all others: those that a batch of
#: documents (COUNT_ROWS at most) holds this often, the commonest of them. They only steer the load.
COMMON_IN_BATCH, COMMON, COUNT_ROWS = 4, 100_000, 2_048
#: 64-bit words of the bitmap that bounds an overlap.
BITMAP_WORDS = 16
#: Bits of the filters that spare work on shingles and sets no pair needs.
FILTER_BITS = 1 << 24
OUT_ROWS = 512

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _M2
    h = (h ^ (h >> _S29)) * _M1
    return h ^ (h >> _S32)


# Value of each byte in a word's hash, A to Z folded; the hash is a polynomial in
# an odd number over 64 bits, from sums over the text so far.
_BASE = 0xC2B2AE3D27D4EB4F
_VALUES = _finish(np.arange(1, 257, dtype=np.uint64) * _M2)
_VALUES[65:91] = _VALUES[97:123]
_IN_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)], np.int8)
#: Bytes of text that are hashed together.
HASH_BYTES = 1 << 18


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    store = worker_store()
    if len(store.get("powers", ((),))[0]) < n:
        size = max(n, 2 * HASH_BYTES)
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers = np.full(size, base, np.uint64)
            powers[0] = 1
            both.append(np.cumprod(powers))
        store["powers"] = tuple(both)
    return store["powers"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each run of anything but ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.diff(_IN_WORD[raw], prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts] if len(starts) else sums[:0]
    return _finish(hashes + (ends - starts).astype(np.uint64)), starts


def _sequences(words: np.ndarray, take: int) -> np.ndarray:
    """Hash of each run of ``take`` words."""
    rows = max(0, len(words) - take + 1)
    mixed = np.full(rows, take, np.uint64)
    for k in range(take):
        mixed = _finish(mixed * _M1 + words[k : k + rows])
    return mixed


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes


def _long_words(text: bytes) -> np.ndarray:
    """Word hashes of a text of any length, cut at white space into pieces."""
    parts, at = [], 0
    while at < len(text):
        found = re.compile(rb"[ \t-\r]").search(text, at + HASH_BYTES)
        end = found.end() if found else len(text)
        parts.append(word_hashes(text[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_sets(texts: list[bytes | None], length: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or b"") <= HASH_BYTES):
            size += len(texts[end] or b"") + 1
            end += 1
        part = [t or b"" for t in texts[at:end]]
        if len(part) == 1 and len(part[0]) > HASH_BYTES:
            words, bounds = _long_words(part[0]), None
            bounds = [0, len(words)]
        else:
            words, starts = word_hashes(b"\n".join(part))
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
            bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])).tolist()
        whole = _sequences(words, length)
        for i, j in zip(bounds, bounds[1:]):
            short = 0 < j - i < length
            out.append(_sequences(words[i:j], j - i) if short else _distinct(whole[i : max(i, j - length + 1)]))
        at = end
    return out


def shingles(text: bytes | None) -> np.ndarray:
    return shingle_sets([text])[0]


def digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes that fall on each bit, as signed 64-bit words."""
    bits = 64 * BITMAP_WORDS
    hits = np.bincount((hashes >> np.uint64(17)).astype(np.int64) % bits, minlength=bits)
    return np.packbits((hits & 1).astype(np.uint8)).view("<i8")


def ordered(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The hashes in the join's order: common ones last, by count; all else by hash."""
    if not len(common):
        return hashes
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    known = common[at] == hashes
    late = hashes[known]
    return np.concatenate([hashes[~known], late[np.lexsort((late, counts[at[known]]))]])


def _texts(
    batches: Iterator[pa.RecordBatch], column: int, rows: int = OUT_ROWS
) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            yield part, part.column(column).to_pylist()


def common_shingles(texts: DataFrame, space: Workspace) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles and their counts, at most COMMON of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches, 0, COUNT_ROWS):
            seen, sets = set(), []
            for own in shingle_sets(texts):
                key = digest(own)
                if key not in seen:
                    seen.add(key)
                    sets.append(own)
            found, n = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]), return_counts=True)
            often = n >= COMMON_IN_BATCH
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["token", "n"]
            )

    found = texts.mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    # Written first: collecting a sorted limit would bring each task's own head along.
    top = space.save(found.orderBy(F.desc("n"), "token").limit(COMMON), "common").toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["n"].to_numpy(np.int64)[order]


_SETS = "n int, class binary, pack binary, prefix binary, bits array<bigint>"


def set_table(rows: DataFrame, space: Workspace, percent: int) -> DataFrame:
    """Size, class, group (``pack``), prefix and bitmap of each (key, text, mark)."""
    common, counts = common_shingles(rows.select("text"), space)
    known = rows.sparkSession.sparkContext.broadcast((common, counts))  # at most COMMON pairs

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = known.value
        for part, texts in _texts(batches, 1):
            out: list[tuple] = []
            for own in shingle_sets(texts):
                n = len(own)
                first = ordered(own, common, counts)[: prefix_length(n, percent) if n else 0].tobytes()
                pack = xxhash.xxh3_128_digest(n.to_bytes(4, "little") + first)
                out.append((n, digest(own), pack, first, bitmap(own)))
            columns = list(zip(*out))
            types = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                ["key", "mark", "n", "class", "pack", "prefix", "bits"],
            )

    return rows.mapInArrow(build, f"key bigint, mark bigint, {_SETS}")


def _filter(places: DataFrame) -> np.ndarray:
    """A bitmap of fixed size over the column ``place`` (0 to FILTER_BITS - 1)."""
    words = (
        places.select(
            F.expr("cast(place div 64 as int)").alias("word"),
            F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit"),
        ).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table


def _held(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 6] >> (places & 63)) & 1 == 1


def _postings(groups: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(token, pos, n, pack): a row for each prefix shingle of a group.

    ``only`` is a filter on tokens that lets some others through.
    """
    known = groups.sparkSession.sparkContext.broadcast(only)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, prefixes in _texts(batches, 2):
            arrays = [np.frombuffer(p, np.int64) for p in prefixes]
            lengths = np.array([len(a) for a in arrays], np.int64)
            tokens, which = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), lengths)
            places = np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])
            if known.value is not None:
                kept = _held(known.value, tokens & (FILTER_BITS - 1))
                tokens, which, places = tokens[kept], which[kept], places[kept]
            rows = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(places), part.column(1).take(rows), part.column(0).take(rows)],
                ["token", "pos", "n", "pack"],
            )

    return groups.select("pack", "n", "prefix").mapInArrow(
        spread, "token bigint, pos int, n int, pack binary"
    )


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sets that first meet at these positions can be similar.

    By size; by the elements left from the positions on; and by the repeated
    prefix shingles left: of the prefix that ends first, every shingle the other
    set has is in the other's prefix, so the overlap is at most those two
    prefixes' common shingles and the rest of the set.
    """
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(n1 - F.col(f"{a}.pos"), n2 - F.col(f"{b}.pos"))
    both = F.least(F.col(f"{a}.left"), F.col(f"{b}.left"))
    larger = F.greatest(n1, n2)
    # prefix = n - ceil(percent n) + 1, so the rest of a set is ceil(percent n) - 1.
    rest = F.expr(f"(({percent} * greatest({a}.n, {b}.n) + 99) div 100) - 1")
    return (
        (100 * F.least(n1, n2) >= percent * larger)
        & ((100 + percent) * most >= percent * (n1 + n2))
        & ((100 + percent) * (both + rest) >= percent * (n1 + n2))
    )


def _bounded_overlap(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Class pairs whose bitmaps leave room for the similarity."""
    left = classes.select(F.col("class").alias("a"), F.col("n").alias("n1"), F.col("bits").alias("bits1"))
    right = classes.select(F.col("class").alias("b"), F.col("n").alias("n2"), F.col("bits").alias("bits2"))
    apart = F.aggregate(
        F.zip_with("bits1", "bits2", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda total, x: total + x,
    )
    both = F.col("n1") + F.col("n2")
    # common <= (n1 + n2 - differing bits) / 2, and it takes percent / (100 + percent) of n1 + n2.
    enough = (100 + percent) * (both - apart) >= 2 * percent * both
    return pairs.join(left, "a").join(right, "b").where(
        (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & enough
    ).select("a", "b")


def similar(left: bytes, right: bytes, percent: int) -> bool:
    """Exact test on two sorted arrays of hashes."""
    a, b = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, texts: DataFrame, space: Workspace, name: str, percent: int) -> DataFrame:
    """Those of the class pairs (a, b) whose whole sets are similar."""
    ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class")))
    place = F.conv(F.hex(F.substring("class", 1, 3)), 16, 10).cast("bigint")
    known = texts.sparkSession.sparkContext.broadcast(_filter(ends.select(place.alias("place"))))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _texts(batches, 0):
            built: dict[bytes, bytes] = {}
            for own in shingle_sets(part):
                key = digest(own)
                if _held(known.value, np.array([int.from_bytes(key[:3], "big")]))[0]:
                    built[key] = own.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(built), pa.binary()), pa.array(list(built.values()), pa.binary())],
                ["class", "hashes"],
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = [similar(x.as_py(), y.as_py(), percent) for x, y in zip(left, right)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(good, pa.bool_())) for k in (0, 1)], ["a", "b"]
            )

    every = texts.mapInArrow(wanted, "class binary, hashes binary")
    sets = space.save(
        every.join(ends.distinct(), "class", "left_semi").dropDuplicates(["class"]), f"{name}-sets"
    )
    left = sets.select(F.col("class").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("hashes").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    links = space.save(joined.mapInArrow(compare, "a binary, b binary"), f"{name}-links")
    space.drop(f"{name}-sets")
    return links


#: The first round pairs the groups of a shingle with the first and the last of them,
#: which makes all pairs where there are up to three.
SETTLED = 3

#: Words of the smaller bitmap that entries carry: halves of the large one, folded.
_SKETCH = [f"s{k}" for k in range(BITMAP_WORDS // 2)]


def _live(posted: DataFrame, labelled: DataFrame, classes: DataFrame, space: Workspace, name: str) -> DataFrame:
    """Entries of shingles that meet classes of several components, with their group's
    labels and, for a group of one class, its folded bitmap.

    Shingles of so few groups that the first round made all pairs are left out,
    if each of the groups is one class.
    """
    half = len(_SKETCH)
    folded = [
        F.when(F.col("members") == 1, F.col("bits")[k].bitwiseXOR(F.col("bits")[k + half])).alias(s)
        for k, s in enumerate(_SKETCH)
    ]
    ranges = labelled.join(classes.select("class", "bits"), "class").groupBy("pack").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.count(F.lit(1)).alias("members"), F.any_value("bits").alias("bits"),
    ).select("pack", "low", "high", "members", *folded)
    entries = posted.join(ranges.select("pack", "low", "high", "members"), "pack")
    mixed = entries.groupBy("token").agg(
        F.min("low").alias("l"), F.max("high").alias("h"),
        F.count(F.lit(1)).alias("groups"), F.max("members").alias("members"),
    ).where(f"l != h AND (groups > {SETTLED} OR members > 1)")
    live = posted.join(mixed.select("token"), "token", "left_semi").join(ranges.drop("members"), "pack")
    return space.save(live, f"{name}-live")


def _apart(x: str, y: str) -> Column:
    """Whether two groups may hold classes of different components."""
    same = [F.col(f"{x}.low") == F.col(c) for c in (f"{x}.high", f"{y}.low", f"{y}.high")]
    return ~(same[0] & same[1] & same[2])


def _star_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Group pairs (g, h), h the first or last group of a shingle: two rows an entry at most.

    First comes the group with the fewest shingles of its own, which in a crowd of
    near copies is the one most of them are close to.
    The first and the last of a shingle meet once, as (last, first).
    """
    entry, end = F.struct("pack", "n", "pos", "left"), F.struct("alone", "pack", "n", "pos", "left")
    ends = entries.groupBy("token").agg(F.min(end).alias("first"), F.max(end).alias("last"))
    both = entries.join(ends, "token").where(F.col("pack") != F.col("first.pack")).select(
        entry.alias("x"), F.explode(F.array("first", "last")).alias("y")
    )
    return both.where(
        (F.col("x.pack") != F.col("y.pack")) & _possible("x", "y", percent)
    ).select(F.col("x.pack").alias("g"), F.col("y.pack").alias("h"))


def _room(x: str, y: str, percent: int) -> Column:
    """Whether the folded bitmaps leave room for the similarity; unknown is yes."""
    apart = sum(
        (F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _SKETCH), F.lit(0)
    )
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    return F.coalesce((100 + percent) * (both - apart) >= 2 * percent * both, F.lit(True))


def _all_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All group pairs (g, h) that share a shingle and may join two components.

    A pair that has the same shingle before this one too has met there already,
    so it is made where a run of common shingles begins, the first at least.
    """
    x, y = entries.alias("x"), entries.alias("y")
    met_before = F.coalesce(F.col("x.prev") == F.col("y.prev"), F.lit(False))
    return x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & (F.col("x.pack") < F.col("y.pack")) & ~met_before
        & _possible("x", "y", percent) & _apart("x", "y") & _room("x", "y", percent),
    ).select(F.col("x.pack").alias("g"), F.col("y.pack").alias("h"))


def _class_pairs(met: DataFrame, labelled: DataFrame, whole: bool) -> DataFrame:
    """Class pairs (a, b) of group pairs, and of groups with themselves, across components.

    Unless ``whole``, the second group is represented by one class.
    """
    groups = labelled.groupBy("pack").agg(
        F.min("class").alias("class"), F.min_by("label", "class").alias("label"), F.count(F.lit(1)).alias("members")
    )
    own = groups.where("members > 1").select(F.col("pack").alias("g"), F.col("pack").alias("h"))
    left = labelled.select(F.col("pack").alias("g"), F.col("class").alias("c"), F.col("label").alias("p"))
    right = (labelled if whole else groups).select(
        F.col("pack").alias("h"), F.col("class").alias("d"), F.col("label").alias("q")
    )
    return (
        met.union(own).distinct().join(left, "g").join(right, "h").where("p != q")
        .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()
    )


def classes_with_components(
    documents: DataFrame, space: Workspace, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per row: key, mark (hash of the text), n, class, and the component's smallest class.

    Written to ``space``; what the steps before it wrote is gone by then.
    Rows with an empty set have their own key only and no component.
    """
    result, space = space, Workspace(documents.sparkSession, "jaccard-steps")
    rows = documents.select(
        F.col(key).cast("bigint").alias("key"), F.col(text).cast("binary").alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
    )
    sets = space.save(set_table(rows, space, percent), "sets")
    full = sets.where(F.col("n") > 0)
    groups = space.save(full.select("pack", "n", "prefix").dropDuplicates(["pack"]), "groups")
    classes = space.save(full.select("class", "pack", "n", "bits").dropDuplicates(["class"]), "classes")
    members = space.save(sets.select("key", "mark", "n", "class"), "members")
    space.drop("sets")  # prefixes stay by group, bitmaps by class

    # Prefix shingles that two groups have.
    repeated = space.save(
        _postings(groups).groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("token"),
        "repeated",
    )
    only = _filter(repeated.select(F.expr(f"token & {FILTER_BITS - 1}L").alias("place")))
    # ``left``: how many of those a group has from this one on, in the order;
    # ``prev``: the one before it; ``alone``: how many of its prefix no other group has.
    onward = Window.partitionBy("pack").orderBy(F.desc("pos"))
    posted = space.save(
        _postings(groups, only).join(repeated, "token", "left_semi")
        .withColumn("left", F.row_number().over(onward))
        .withColumn("prev", F.lead("token").over(onward))
        .withColumn(
            "alone",
            (F.expr(f"n - (({percent} * n + 99) div 100) + 1") - F.count(F.lit(1)).over(Window.partitionBy("pack"))).cast("int"),
        ),
        "posted",
    )
    space.drop("groups")
    space.drop("repeated")

    # First two pivots per shingle, then every pair that is left.
    links = tested = None
    labelled = classes.select("class", "pack", F.col("class").alias("label"))
    for name in ("star", "rest"):
        if tested is None:
            pairs = _class_pairs(_star_pairs(posted, percent), labelled, whole=False)
        else:
            live = _live(posted, labelled, classes, space, name)
            pairs = _class_pairs(_all_pairs(live, percent), labelled, whole=True)
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        candidates = space.save(_bounded_overlap(pairs, classes, percent), name)
        if tested is not None:  # the pairs are written; what they came from can go
            space.drop(f"{name}-live")
            space.drop("posted")
        more = _verified(candidates, rows.select("text"), space, name, percent)
        tested = candidates
        links = more if links is None else links.union(more)
        found = components(links, space, f"{name}-parts").withColumnsRenamed({"node": "class"})
        labelled = space.save(
            classes.select("class", "pack").join(found, "class", "left")
            .select("class", "pack", F.coalesce("component", "class").alias("label")),
            f"{name}-labels",
        )

    labels = labelled.select("class", F.col("label").alias("component"))
    found = result.save(members.join(labels, "class", "left").select("key", "mark", "n", "class", "component"), "rows")
    space.drop()
    return found


def similarity_components(
    documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key that links reach)."""
    space = Workspace(documents.sparkSession, "jaccard-groups")
    rows = classes_with_components(documents, space, key, text, percent)
    smallest = rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("key").alias("low"))
    return rows.join(smallest, "component", "left").select(
        F.col("key").alias(key), F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key")).alias("component_id"),
    )


def one_per_component(
    documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The documents with only the row of the smallest key of each component, and all empty ones."""
    space = Workspace(documents.sparkSession, "jaccard-kept")
    rows = classes_with_components(documents, space, key, text, percent)
    choice = F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "mark")).alias("kept")
    kept = rows.where("n > 0").groupBy("component").agg(choice).select(
        F.col("kept.key").alias("kept_key"), F.col("kept.mark").alias("kept_mark")
    )
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    given = documents.select(
        F.struct("*").alias("row"), F.col(key).cast("bigint").alias("row_key"), mark.alias("row_mark"),
        F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"),
    )
    chosen = given.where("worded").join(
        kept,
        F.col("row_key").eqNullSafe(F.col("kept_key")) & (F.col("row_mark") == F.col("kept_mark")),
        "left_semi",
    )
    # Equal rows are all chosen by that; only if there are any, one of each is picked.
    if rows.where("n > 0").groupBy("key", "mark").count().where("count > 1").limit(1).count():
        chosen = chosen.dropDuplicates(["row_key", "row_mark"])
    return chosen.select("row.*").union(given.where(~F.col("worded")).select("row.*"))
