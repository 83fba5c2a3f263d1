"""A Merkle manifest of a dataset that keeps few of its levels.

Each row is a leaf, the leaves of a language make a tree, and the roots of the trees make a tree
of their own. Only every eighth level is stored, as rows of an aligned subtree each: the
nodes of such a level, 256 of them at most, below one node of the next stored level. A proof is
extracted from the top down: the nodes between are made again from the stored ones of a
subtree, the siblings of each leaf's way up are taken, and the nodes are dropped.

Digests are lower-case hex text. A node is the digest of its two children one after the
other, or of its only child where the level has an odd number of nodes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark.llm.common import partitions
from veilspark.sources.scratch import materialise

STEP = 8  # levels from one that is stored to the next
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Manifest:
    """Stored levels of the trees and of the tree of their roots, lowest first, and the whole root."""

    trees: list[DataFrame]
    top: list[DataFrame]
    step: int = STEP

    def root(self) -> str | None:
        """The digest of the whole dataset; without rows none."""
        row = roots(self.top, self.step).first()
        return row["node"] if row else None


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(docs: DataFrame, **instead: Column) -> Column:
    """The digest of a row's fields; `instead` gives some of them another value, as text."""
    parts = []
    for name in FIELDS:
        text = instead.get(name, docs[name].cast("string"))
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(*parts)


def build(docs: DataFrame, claimed: Column | None = None, step: int = STEP) -> Manifest:
    """The manifest of all rows, each a leaf of the tree of its `lang`.

    `claimed` is kept with each leaf, the digest that someone says the row has; without it the leaf's
    own. Leaves ascend by doc_id, null first, and rows of one doc_id by their digest, so equal
    rows are leaves as often as they occur. Rows without lang make a tree, the first one.
    Columns besides those of `FIELDS` have no part in it. No rows give empty levels.
    """
    own = leaf(docs)
    name = F.coalesce(F.concat(F.lit("="), docs["lang"]), F.lit("")).alias("tree")
    claim = own if claimed is None else claimed
    rows = docs.select(name, F.struct(docs["doc_id"].cast("long").alias("doc_id"), claim.alias("claimed")).alias("row"), own.alias("node"))
    trees = _levels(_placed(materialise(rows, "leaves"), ["row.doc_id", "node", "row.claimed"]), step)
    subroots = roots(trees, step).select(F.lit("").alias("tree"), F.struct("tree").alias("row"), "node")
    return Manifest(trees, _levels(_placed(materialise(subroots, "subroots"), ["row.tree"]), step), step)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored `rows` with `n`, the rows of their tree, and `pos`, the place among them from 0.

    Rows are dealt in ranges, also equal ones, so no task holds a tree.
    """
    keys = ["tree", *order, "salt"]
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ranges = salted.repartitionByRange(partitions(rows), *keys).sortWithinPartitions(*keys).drop("salt")
    stored = materialise(ranges.withColumns({"slice": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "ranges")
    runs = stored.groupBy("tree", "slice").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")
    starts = runs.select("tree", "slice", shift, F.sum("rows").over(tree).alias("n"))
    return stored.join(starts, ["tree", "slice"]).select("tree", "n", (F.col("place") + F.col("shift")).alias("pos"), "row", "node")


def _levels(nodes: DataFrame, step: int) -> list[DataFrame]:
    """Stored levels: rows tree, n, block and members, the nodes below node `block` of the next stored level, in order."""
    levels = []
    while True:
        block = F.shiftright("pos", step).alias("block")
        members = F.sort_array(F.collect_list(F.struct("pos", "node", "row"))).alias("members")
        levels.append(materialise(nodes.groupBy("tree", "n", block).agg(members), "level"))
        more = _unfinished(len(levels), step)
        if not levels[-1].where(more).take(1):
            return levels
        tops = _interior(levels[-1].where(more), len(levels) - 1, step)
        nodes = tops.select("tree", "n", F.col("block").alias("pos"), F.lit(None).cast("string").alias("row"), F.col(f"level{step}")[0].alias("node"))


def _unfinished(levels: int, step: int) -> Column:
    """Whether a tree has more nodes than so many stored levels can join."""
    return F.col("n") > F.lit(1 << min(62, step * levels))


def _depth(level: int, step: int) -> Column:
    """How many levels above the stored one a tree has, `step` at most."""
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    return F.least(F.lit(step), height - level * step)


def _interior(blocks: DataFrame, level: int, step: int) -> DataFrame:
    """`blocks` with level0, their nodes, to level<step>, the node they make, and `depth`."""
    out = blocks.withColumns({"level0": F.transform("members", lambda m: m["node"]), "depth": _depth(level, step)})
    for below in range(step):
        nodes = F.col(f"level{below}")
        out = out.withColumn(f"level{below + 1}", F.when(F.col("depth") > below, _joined(nodes)).otherwise(nodes))
    return out


def _joined(nodes: Column) -> Column:
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1))
    return F.transform(pairs, lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))


def roots(levels: list[DataFrame], step: int = STEP) -> DataFrame:
    """The root of each tree."""
    out = None
    for level, blocks in enumerate(levels):
        done = _interior(blocks.where(~_unfinished(level + 1, step)), level, step)
        done = done.select("tree", F.col(f"level{step}")[0].alias("node"))
        out = done if out is None else out.unionByName(done)
    return out


def _siblings(place: Column, step: int) -> Column:
    """Of each level the siblings left and right of the way up from `place`, one of them or none."""
    entries = []
    for below in range(step):
        nodes, at = F.col(f"level{below}"), F.shiftright(place, below)
        odd = at % 2 == 1
        left = F.when(odd, F.get(nodes, at - 1)).otherwise("")
        right = F.when(~odd, F.coalesce(F.get(nodes, at + 1), F.lit(""))).otherwise("")
        entries.append(F.struct(left.alias("left"), right.alias("right")))
    return F.slice(F.array(*entries), 1, F.col("depth"))


def _paths(levels: list[DataFrame], above: DataFrame, step: int) -> DataFrame:
    """row, node and path of each leaf, with what `above` has for its tree: path, the siblings above it, and more columns."""
    kept = [name for name in above.columns if name not in ("tree", "path")]
    higher = None
    for level in reversed(range(len(levels))):
        blocks = levels[level]
        if higher is None:
            met = blocks.join(above, "tree")
        else:
            below = higher.select("tree", F.col("pos").alias("block"), "path", *kept)
            met = blocks.where(_unfinished(level + 1, step)).join(below, ["tree", "block"])
            met = met.unionByName(blocks.where(~_unfinished(level + 1, step)).join(above, "tree"))
        own = F.transform("members", lambda m, i: F.struct(m["pos"], m["row"], m["node"], _siblings(i, step).alias("path")))
        each = _interior(met, level, step).select("tree", F.explode(own).alias("own"), F.col("path").alias("rest"), *kept)
        path = F.concat("own.path", "rest").alias("path")
        higher = each.select("tree", "own.pos", "own.row", "own.node", path, *kept)
    return higher.select("row", "node", "path", *kept)


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, claimed, path, subroot and root of each row.

    `path` has an entry for each level up to the root, with the digests that stand left and
    right of the way: one, or none where the way's node has no sibling.
    """
    step = manifest.step
    whole = roots(manifest.top, step).withColumnRenamed("node", "root")
    none = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    top = _paths(manifest.top, whole.select("tree", none, "root"), step)
    subroots = materialise(top.select("row.tree", "path", F.col("node").alias("subroot"), "root"), "subroots")
    return _paths(manifest.trees, subroots, step).select("row.doc_id", F.col("node").alias("leaf"), "row.claimed", "path", "subroot", "root")


def folded(leaf: Column | str, path: Column | str) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, F.col(leaf) if isinstance(leaf, str) else leaf, lambda node, at: digest(at["left"], node, at["right"]))


def proof_digest(path: Column | str) -> Column:
    """The digest of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), ""), 256)
