"""Merkle manifest of a table: digest-to-children records, and proofs read from them.

Every row is a leaf: the SHA-256 of its fields, each with its length, or `-` for
null. In each group (here the language) the leaves stand by key; eight
consecutive nodes become one, level by level, until one is left, the group's
subroot, and the subroots, ordered by group, are joined to the root likewise.
Each node is stored as a record: its digest and the digests of its children.

Proofs come from the records alone. The requests of all leaves start at the
root; at each level a request looks its node's record up by digest, takes the
child its rank's digit names and puts the children it did not take on its path.
Requests that agree in their digits so far travel as one row, so a level costs
as many rows as it has nodes, and none is hot. At the leaves the path is turned
round: siblings from the leaf to the root.

Defined cases: a null in any field counts as `-`; null keys come first in their
group and are never tampered with; rows that repeat a key stand by leaf digest,
and equal rows get each a place of their own, whatever their order; a null group
comes before all others; an empty table has no root and no rows; other columns
are not read, and those named like a column made here do no harm.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import ascii_lower, numbered
from basketlens.sources.staging import Workspace

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose key's CRC this number divides are tampered with.
TAMPERED = 3


def hashed(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def digits(digest: Column) -> Column:
    """Bytes as lower-case hex text."""
    return F.lower(F.hex(digest))


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: per field its bytes in UTF-8, a colon and the value, or `-`."""
    texts = [v.cast("string") for v in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return hashed(F.concat(*parts))


def nothing() -> Column:
    return F.lit("").cast("binary")


def joined(parts: Column) -> Column:
    """Digests of an array, one after the other."""
    return F.aggregate(parts, nothing(), lambda all_, x: F.concat(all_, x))


@dataclass
class Manifest:
    """Stored records, lowest level first, and what leads to them.

    ``runs``: tree, idx, digest, children, members (the leaves' key, leaf, changed), alone.
    ``levels``: records (tree, idx, nodes, digest, children) of the levels above, per group;
    ``top``: those of the tree over the subroots. ``subroots``: tree, height, digest, position.
    """

    runs: DataFrame
    subroots: DataFrame
    levels: list[DataFrame] = field(default_factory=list)
    top: list[DataFrame] = field(default_factory=list)
    root: bytes | None = None


def _parents(nodes: DataFrame) -> DataFrame:
    """The level above (tree, idx, nodes, digest): runs of eight, the last maybe shorter."""
    run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
    grouped = nodes.groupBy("tree", F.expr(f"idx div {FANOUT}").alias("up")).agg(
        run.alias("run"), F.max("nodes").alias("below")
    )
    children = F.col("run.digest")
    return grouped.select(
        "tree",
        F.col("up").alias("idx"),
        F.expr(f"(below + {FANOUT - 1}) div {FANOUT}").alias("nodes"),
        hashed(digits(joined(children))).alias("digest"),
        children.alias("children"),
    )


def _climbed(nodes: DataFrame, space: Workspace, name: str) -> list[DataFrame]:
    """Levels above ``nodes`` until every tree has one node; a tree stops when it has."""
    levels = []
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        nodes = space.save(_parents(nodes.where("nodes > 1")), f"{name}-{len(levels)}")
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def ranked_leaves(leaves: DataFrame, space: Workspace) -> DataFrame:
    """Add ``idx`` (0, 1, ... by key and leaf in the tree) and ``total`` of the tree.

    Rows are dealt into ranges of tree, key and leaf, so a large tree spans many;
    rows of a tree in a range are counted, and numbered inside it.
    """
    order = ["key", "leaf"]
    ranged = leaves.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id())
    saved = space.save(ranged, "leaves")
    tree = Window.partitionBy("tree")
    parts = saved.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "tree", "part",
        F.coalesce(
            F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
        F.sum("n").over(tree).alias("total"),
    )
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    return (
        saved.withColumn("inside", inside)
        .join(parts, ["tree", "part"])
        .withColumn("idx", F.col("before") + F.col("inside") - 1)
        .drop("part", "before", "inside")
    )


def manifest(leaves: DataFrame, space: Workspace) -> Manifest:
    """Records of all levels over (tree, key, leaf, changed); trees are ordered by ``tree``."""
    run = F.sort_array(F.collect_list(F.struct("idx", "key", "leaf", "changed")))
    grouped = ranked_leaves(leaves, space).groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(
        run.alias("members"), F.max("total").alias("total")
    )
    alone, children = F.col("total") == 1, F.col("members.leaf")
    runs = space.save(
        grouped.select(
            "tree", "idx",
            F.expr(f"(total + {FANOUT - 1}) div {FANOUT}").alias("nodes"),
            # A lone leaf is its own subroot.
            F.when(alone, F.element_at(children, 1)).otherwise(hashed(digits(joined(children)))).alias("digest"),
            children.alias("children"),
            F.transform("members", lambda m: m.dropFields("idx")).alias("members"),
            alone.alias("alone"),
        ),
        "runs",
    )
    levels = _climbed(runs.select("tree", "idx", "nodes", "digest"), space, "level")
    roots = runs.where("nodes = 1").select(
        "tree", F.when(F.col("alone"), 0).otherwise(1).alias("height"), "digest"
    )
    for height, level in enumerate(levels, 2):
        roots = roots.unionByName(
            level.where("nodes = 1").select("tree", F.lit(height).alias("height"), "digest")
        )
    subroots = space.save(numbered(roots, ["tree"], space, "groups"), "subroots")
    over = subroots.select(
        F.lit("").alias("tree"), F.col("position").alias("idx"), F.col("total").alias("nodes"), "digest"
    )
    top = _climbed(over, space, "top")
    last = (top[-1] if top else over).select("digest").first()
    return Manifest(runs, subroots, levels, top, bytes(last[0]) if last else None)


def _descended(requests: DataFrame, level: DataFrame) -> DataFrame:
    """One level down: the record by digest, and a request row for each child."""
    # Equal subtrees share a record.
    records = level.groupBy("digest").agg(F.first("children").alias("children"))
    return (
        requests.join(records, "digest")
        .select("*", F.posexplode("children").alias("digit", "child"))
        .select(
            "tree", "subroot",
            (F.col("idx") * FANOUT + F.col("digit")).alias("idx"),
            F.col("child").alias("digest"),
            F.concat("path", F.array(_unselected("children", F.col("digit")))).alias("path"),
        )
    )


def _unselected(children: str, digit: Column) -> Column:
    """The other children, left and right of the selected one."""
    return F.struct(
        joined(F.slice(children, F.lit(1), digit)).alias("left"),
        joined(F.slice(children, digit + 2, F.lit(FANOUT))).alias("right"),
    )


_PATH = "array<struct<left:binary,right:binary>>"


def proofs(built: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Per leaf: key, tree, idx, leaf, changed, subroot and path (leaf to root).

    ``wanted`` (tree, idx of a leaf in its tree) limits the requests to some
    leaves; requests then follow only the digits that lead to them.
    """
    spark = built.runs.sparkSession
    start = spark.range(1).where(F.lit(built.root is not None)).select(
        F.lit("").alias("tree"), F.lit(None).cast("binary").alias("subroot"), F.lit(0).cast("bigint").alias("idx"),
        F.lit(built.root).cast("binary").alias("digest"), F.array().cast(_PATH).alias("path"),
    )
    for level in reversed(built.top):
        start = _descended(start, level)
    groups = start.select(F.col("idx").alias("position"), "path").join(built.subroots, "position").select(
        "tree", F.col("digest").alias("subroot"), F.lit(0).cast("bigint").alias("idx"), "digest", "path", "height"
    )

    def asked(requests: DataFrame, height: int) -> DataFrame:
        if wanted is None:
            return requests
        prefixes = wanted.select("tree", F.expr(f"idx div {FANOUT**height}").alias("idx")).distinct()
        return requests.join(prefixes, ["tree", "idx"], "left_semi")

    requests = groups.where(F.lit(False)).drop("height")
    for height in range(len(built.levels) + 1, 0, -1):
        entering = groups.where(F.col("height") == height).drop("height")
        requests = asked(requests.unionByName(entering), height)
        if height > 1:
            requests = _descended(requests, built.levels[height - 2])
    requests = requests.unionByName(groups.where("height = 0").drop("height"))
    # The lowest records, together with the leaves that ask.
    found = requests.join(built.runs.drop("nodes"), ["tree", "idx", "digest"])
    each = found.select("*", F.posexplode("members").alias("digit", "member"))
    whole = F.when(F.col("alone"), F.col("path")).otherwise(
        F.concat("path", F.array(_unselected("children", F.col("digit"))))
    )
    rows = each.select(
        "member.*", "tree", "subroot", (F.col("idx") * FANOUT + F.col("digit")).alias("idx"),
        F.reverse(whole).alias("path"),
    )
    if wanted is not None:
        rows = rows.join(wanted.select("tree", "idx").distinct(), ["tree", "idx"], "left_semi")
    return rows.select("key", "tree", "idx", "leaf", "changed", "subroot", "path")


def proof_text(path: Column) -> Column:
    """The siblings, level by level, as hex text."""
    return digits(F.aggregate(path, nothing(), lambda all_, s: F.concat(all_, s["left"], s["right"])))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(
        path, leaf, lambda node, s: hashed(digits(F.concat(s["left"], node, s["right"])))
    )


def verified_rows(
    documents: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text",
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified, digests as hex text.

    Where the key's CRC says so, ``folded_root`` is recomputed from the leaf of
    the row with its text's A-Z lower-cased, else from the row as it is.
    """
    space = Workspace(documents.sparkSession, "merkle")
    plain = [F.col(f) for f in fields]
    lowered = [ascii_lower(F.col(f)) if f == text else F.col(f) for f in fields]
    tampered = F.crc32(F.col(key).cast("string").cast("binary")) % TAMPERED == 0
    leaves = documents.select(
        # Sorts as the group does, with null first and never null.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.col(key).alias("key"),
        leaf_digest(plain).alias("leaf"),
        F.when(tampered, leaf_digest(lowered)).alias("changed"),
    )
    built = manifest(leaves, space)
    rows = proofs(built)
    root = F.lit(built.root).cast("binary")
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    return rows.select(
        F.col("key").alias(key),
        digits(F.col("leaf")).alias("leaf"),
        digits(F.col("subroot")).alias("subroot"),
        digits(root).alias("root"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        digits(again).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
