"""Merkle manifest of a dataset: few levels are stored, proofs regenerate the nodes between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantpulse.llm.text import ascii_lower
from plantpulse.session import cut

#: Children of a node.
FAN = 16
#: Levels from one stored level to the next; a stored node stands for an aligned subtree of at most FAN ** STRIDE nodes.
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left:string,right:string>"


@dataclass
class Forest:
    """Stored levels of several trees. Level i has (tree, at, m, digest) of every STRIDE * i-th level of the trees that reach
    it, ``m`` being the nodes of the tree on that level; a tree's last row, with m = 1, is its top. Level 0 also has the leaves'
    own columns."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(tree, digest): the root of each tree."""
        found = [level.filter("m = 1").select("tree", "digest") for level in self.levels]
        out = found[0]
        for other in found[1:]:
            out = out.union(other)
        return out


@dataclass
class Manifest:
    """Trees of the groups, and the tree over their roots."""

    groups: Forest
    upper: Forest


def encoded(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the encoded columns."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (place from 0 within ``tree`` by ``order``) and ``m`` (rows of the tree).

    Rows are dealt out by ranges of (tree, order), so a tree of any size spreads over many tasks; a task numbers its own
    rows, and the rows of a tree in earlier ranges are added from a table with one row per range and tree.
    """
    keys = ["tree", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut(ranged.drop("_tie").withColumn("_range", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()), "merkle-places")
    parts = placed.groupBy("tree", "_range").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before, whole = Window.partitionBy("tree").orderBy("_range"), Window.partitionBy("tree")
    parts = parts.select("tree", "_range", (F.sum("_rows").over(before) - F.col("_rows") - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("m"))
    return placed.join(parts, ["tree", "_range"]).withColumn("at", F.col("_i") + F.col("_shift")).drop("_range", "_i", "_shift")


def _parents(nodes: Column) -> Column:
    """Digests of every FAN consecutive nodes of an array."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(nodes, r * FAN + 1, FAN), ""), 256))


def _interior(subtrees: DataFrame, stride: int) -> DataFrame:
    """Adds ``level0`` to ``level<stride>``, the nodes of each subtree level by level; a tree's root is not hashed again."""
    out = subtrees.withColumn("level0", F.transform("nodes", lambda x: x["digest"]))
    for k in range(stride):
        below = F.col(f"level{k}")
        out = out.withColumn(f"level{k + 1}", F.when(F.col("m") > FAN**k, _parents(below)).otherwise(below))
    return out


def _subtrees(level: DataFrame, stride: int, own: list[str]) -> DataFrame:
    """One row per aligned subtree that has a parent: its nodes in order, at most FAN ** stride of them."""
    grouped = level.filter("m > 1").groupBy("tree", F.floor(F.col("at") / FAN**stride).alias("parent"), "m")
    return grouped.agg(F.array_sort(F.collect_list(F.struct("at", "digest", *own))).alias("nodes"))


def grow(leaves: DataFrame, order: list[str], stride: int = STRIDE) -> Forest:
    """Trees over ``leaves`` (tree, digest, own columns), in the order of ``order`` and the digest."""
    levels = [numbered(leaves, [*order, "digest"])]
    while (levels[-1].agg(F.max("m")).first()[0] or 0) > 1:
        done = _interior(_subtrees(levels[-1], stride, []), stride)
        levels.append(cut(done.select(
            "tree", F.col("parent").alias("at"), F.ceil(F.col("m") / FAN**stride).alias("m"), F.col(f"level{stride}")[0].alias("digest"),
        ), "merkle-level"))
    return Forest(levels)


def _siblings(nodes: Column, at: Column) -> Column:
    """The others of a node's run, concatenated: those to its left and those to its right."""
    first = at - at % FAN
    left = F.array_join(F.slice(nodes, first + 1, at - first), "")
    right = F.array_join(F.slice(nodes, at + 2, first + FAN - 1 - at), "")
    return F.struct(left.alias("left"), right.alias("right")).cast(_STEP)


def paths(forest: Forest, above: DataFrame, own: list[str], stride: int = STRIDE) -> DataFrame:
    """(tree, digest, own columns, path, root) of all leaves.

    ``above`` gives each tree's (root, path) beyond its own top. From the top down, the nodes between two stored levels
    are made again from the stored ones below, per aligned subtree; each node gets the siblings at its levels before the
    path of its subtree, and the made nodes are dropped. A path holds one (left, right) per level, lowest first.
    """
    known = None
    for depth in reversed(range(len(forest.levels))):
        keep = own if depth == 0 else []
        level = forest.levels[depth]
        tops = level.filter("m = 1").join(above, "tree").select("tree", "at", "digest", *keep, "path", "root")
        if known is None:
            known = tops
            continue
        parents = known.select("tree", F.col("at").alias("parent"), F.col("path").alias("_path"), F.col("root").alias("_root"))
        whole = _interior(_subtrees(level, stride, keep), stride).join(parents, ["tree", "parent"])

        def step(x: Column, i: Column) -> Column:
            steps = [F.when(F.col("m") > FAN**k, F.array(_siblings(F.col(f"level{k}"), F.floor(i / FAN**k).cast("int")))).otherwise(F.array().cast(f"array<{_STEP}>")) for k in range(stride)]
            return F.struct(x["at"].alias("at"), x["digest"].alias("digest"), *[x[c].alias(c) for c in keep], F.concat(*steps, "_path").alias("path"))

        each = whole.select("tree", "_root", F.explode(F.transform("nodes", step)).alias("x"))
        known = tops.unionByName(each.select("tree", "x.*", F.col("_root").alias("root")))
    return known.drop("at")


def manifest(leaves: DataFrame, order: list[str], stride: int = STRIDE) -> Manifest:
    """Trees of ``leaves`` (tree, digest, own columns), and the tree over their roots in the order of ``tree``."""
    groups = grow(leaves, order, stride)
    return Manifest(groups, grow(groups.tops().select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), ["of"], stride))


def proofs(built: Manifest, own: list[str], stride: int = STRIDE) -> DataFrame:
    """(tree, subroot, root, digest, own columns, path) of every leaf; the path leads to the root of the whole dataset."""
    start = built.upper.tops().select("tree", F.col("digest").alias("root"), F.array().cast(f"array<{_STEP}>").alias("path"))
    above = paths(built.upper, start, ["of"], stride)
    above = above.select(F.col("of").alias("tree"), F.struct("root", F.col("digest").alias("subroot")).alias("root"), "path")
    leaves = paths(built.groups, above, own, stride)
    return leaves.select("tree", "root.subroot", "root.root", "digest", *own, "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def merkle_manifest(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of (doc_id, source, lang, n_chars, text). The documents of a source form a tree with FAN children per
    node, the sources' roots another. Where 5 divides the CRC-32 of the identifier, the proof is checked against a leaf
    whose text has A-Z lower-cased, all others against their own leaf. Only digests leave the documents' tasks. Besides
    the leaves, every ``stride``-th level is stored; no group holds more than FAN ** stride digests, however large a
    source is, and only the height of the highest tree reaches the driver.

    Nulls are encoded as ``-``, so they differ from empty texts; a null source is a source of its own, before all others,
    and documents without an identifier come first in their source and are never tampered with. Rows that repeat an
    identifier are all leaves, in the order of their digests; rows alike in all five columns are leaves next to each other
    with a proof each. The only document of a table is leaf, subroot and root at once, with an empty list of siblings. An
    empty table gives an empty result; other columns are not read.
    """
    cols = {name: F.col(f"`{name}`") for name in FIELDS}
    tampered = F.crc32(cols["doc_id"].cast("string").cast("binary")) % 5 == 0
    changed = {**cols, "text": ascii_lower(cols["text"])}
    leaves = cut(docs.select(
        F.when(cols["source"].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), cols["source"].cast("string"))).alias("tree"),
        cols["doc_id"].alias("id"), row_digest(*cols.values()).alias("digest"), F.when(tampered, row_digest(*changed.values())).alias("other"),
    ), "merkle-leaves")
    own = ["id", "other"]
    proved = proofs(manifest(leaves, ["id"], stride), own, stride)
    out = proved.withColumn("folded_root", folded(F.coalesce("other", "digest"), F.col("path")))
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
